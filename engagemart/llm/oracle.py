"""Expected results in SQL for the operators that SQL can express.

Operators 1, 5 and 8 leave choices open (any balanced shards, any tight packing, any mix near its
targets), 3 learns, 9 needs a digest that SQL lacks, and 11 and 13 need tokenizers: their tests use brute force.
"""

_WORD = "[^\\x20\\x09-\\x0D]+"

OP6 = """
with n as (
  select doc_id, coalesce(text, '') as t,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm
  from documents),
k as (
  select doc_id, norm, row_number() over (partition by norm order by length(t) desc, doc_id) as place,
         count(*) over (partition by norm) as group_size
  from n)
select k.doc_id, b.doc_id as keep_id, k.group_size, k.doc_id = b.doc_id as kept, sha256(k.norm) as text_sha256
from k join (select norm, doc_id from k where place = 1) b on k.norm = b.norm
"""

OP12 = r"""
with t as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents where text is not null),
p as (select doc_id, term, count(*) as tf from t group by all),
l as (select doc_id, cast(sum(tf) as bigint) as n from p group by doc_id),
s as (select count(*) as docs, cast(sum(n) as bigint) as total from l),
q as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark where text is not null),
f as (select term, count(*) as df from p where term in (select term from q) group by term),
w as (select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w from f, s),
c as (
  select p.doc_id, p.term, w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (100 - 50 + ((50 * l.n * s.docs) // s.total)))) as gain
  from p join w on p.term = w.term join l on p.doc_id = l.doc_id, s),
x as (select q.item_id, c.doc_id, cast(sum(c.gain) as bigint) as score from q join c on q.term = c.term group by all),
r as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as place from x where score > 0)
select item_id, cast(place as integer) as rank, doc_id, score from r where place <= 50
"""

ORACLE_SQL = {"op6_exact_dedup": OP6, "op12_lexical_search": OP12}
