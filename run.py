"""Entry script for ``spark-submit run.py <job> ...``; see ``python -m engagemart -h``."""

from engagemart.__main__ import main

if __name__ == "__main__":
    main()
