"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations


#: Words of the decontamination contract, A-Z lower-cased.
_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP8 = f"""
with d as (select doc_id, coalesce({_WORDS}, []) as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
win as (select distinct item_id, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') as win, least(13, len(w)) as n
        from (select item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as s from b where len(w) > 0)),
sizes as (select distinct n from win),
runs as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as s, w from d, sizes where len(w) >= n),
hit as (select r.doc_id, r.s, r.n, win.item_id
        from (select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') as win from runs) r
        join win on r.win = win.win and r.n = win.n),
words as (select doc_id, count(distinct p) as n_hit
          from (select doc_id, unnest(range(s, s + n)) as p from hit) group by doc_id),
items as (select doc_id, count(distinct item_id) as n_items,
                 string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
          from hit group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""


OP6 = """
with t as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
n as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as pos,
             count(*) over (partition by conv_id) as size,
             '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as line from t),
p as (select *, string_agg(line, '') over (partition by conv_id order by pos) as upto from n),
whole as (select conv_id, size, upto from p where pos = size - 1),
inner_ as (select distinct pos + 1 as size, upto from p where pos < size - 1),
best as (select min(conv_id) as conv_id, count(*) as copies from whole anti join inner_ using (size, upto)
         group by size, upto)
select conv_id, pos // 32 as part, max(size) as n_turns, max(copies) as copies,
       string_agg(line, '' order by pos) as rendered
from n join best using (conv_id) group by conv_id, pos // 32
"""


#: Base 32 of a SHA-1, five bits at a time from its hexadecimal digits.
OP12 = """
with p as (select row_number() over () as row, page_id, coalesce(html, '') as payload from pages),
d as (select row, page_id, cast(strlen(payload) as bigint) as payload_bytes, sha1(payload) as hex from p),
b as (select row, page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + cast((cast('0x' || substr(hex, 1 + 5 * (i // 4), 5) as bigint) >> (5 * (3 - i % 4))) & 31 as int), 1)), '')
        as payload_digest from d),
r as (select *, row_number() over (partition by payload_digest, payload_bytes order by page_id desc nulls last) as place,
             max(page_id) over (partition by payload_digest, payload_bytes) as kept from b)
select page_id, payload_bytes, payload_digest, case when place = 1 then 'response' else 'revisit' end as record_type,
       case when place > 1 then kept end as refers_to from r
"""


OP13 = r"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents where text is not null),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (select lang, k, w[s:s + k - 1] as g from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as s
          from w, (select unnest([1, 2, 3]) as k) where len(w) >= k)),
c as (select lang, k, g, cast(count(*) as hugeint) as f from grams group by all),
totals as (select lang, cast(sum(f) as bigint) as n from c where k = 1 group by lang),
many as (select * from c where f >= 10),
cuts as (select p.lang, p.g, p.k, p.f as a, x.k as cut, x.f as l, y.f as r, (1000000 * p.f * p.f) // (x.f * y.f) as score
         from many p join many x on p.lang = x.lang and x.k < p.k and x.g = p.g[1:x.k]
                     join many y on p.lang = y.lang and y.k = p.k - x.k and y.g = p.g[x.k + 1:p.k] where p.k >= 2),
best as (select * from (select *, row_number() over (partition by lang, g order by score, cut) as place from cuts)
         where place = 1),
long as (select lang, unnest([g[1:2], g[2:3]]) as g, f from many where k = 3),
covered as (select distinct p.lang, p.g from best p join long x using (lang, g) where 100 * x.f >= 50 * p.a),
ranked as (select b.*, array_to_string(b.g, ' ') as phrase, row_number() over (partition by b.lang
           order by b.score desc, b.a desc, array_to_string(b.g, ' ')) as rank
           from best b anti join covered c on b.lang = c.lang and b.g = c.g)
select lang, rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, n,
       cast(score as bigint) as score
from ranked join totals using (lang) where rank <= 2000
"""


#: Near words by what is left without one code point; letters from U+00C0 on are
#: single bytes there, since the edit distance counts bytes.
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_SIGNS = "".join(map(chr, range(0x21, 0x61))).replace("'", "''")
OP11 = f"""
with recursive g(i, k, x) as (select i, 0, cast(i as bigint) from range(256) r(i) union all
    select i, k + 1, xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end) from g where k < 8),
crc as (select list(x order by i) as t from g where k = 8),
runs as (select d, run, count(*) as c, encode(d || ':' || run) as raw from (
    select coalesce(cast(doc_id as varchar), '') as d, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) as run
    from documents) group by d, run),
hashed as (select run, c, xor(list_reduce(list_transform(range(0, octet_length(raw)),
        lambda i: cast('0x' || substr(hex(raw), 2 * i + 1, 2) as bigint)),
        lambda h, b: xor(t[1 + (xor(h, b) & 255)], h >> 8), cast(4294967295 as bigint)), 4294967295) as h
    from runs, crc),
words as (select word, cast(sum(c) as bigint) as n from (select c, case when h % 31 = 0 then
        substr(run, 1, cast(h % length(run) as int)) || substr(run, cast(h % length(run) as int) + 2) else run end as word
    from hashed) where length(word) >= 7 group by word having sum(c) >= 2),
less as (select word, n, word as v from words union all
    select word, n, substr(word, 1, i) || substr(word, i + 2) from (select word, n, unnest(range(0, length(word))) as i from words)),
pairs as (select distinct a.word, a.n, b.word as other, b.n as m from less a join less b using (v)
    where levenshtein(translate(a.word, '{_ACCENTED}', '{_SIGNS}'), translate(b.word, '{_ACCENTED}', '{_SIGNS}')) = 1),
best as (select *, row_number() over (partition by word order by m desc, other) as place, count(*) over (partition by word) as n_near
    from pairs),
forms as (select w.word, w.n, cast(coalesce(n_near, 0) as bigint) as n_near, case when m >= 10 * w.n then other end as form,
        case when m >= 10 * w.n then m end as form_n
    from words w left join best b on w.word = b.word and place = 1),
roots(word, upto, step) as (select word, coalesce(form, word), 1 from forms union all
    select r.word, f.form, step + 1 from roots r join forms f on r.upto = f.word where f.form is not null)
select f.word, form, (select upto from roots r where r.word = f.word order by step desc limit 1) as root, n, n_near, form_n
from forms f
"""


def oracle_sql() -> dict[str, str]:
    """SQL per query name."""
    return {"op6_chat": OP6, "op8_decontaminate": OP8, "op11_spelling": OP11, "op12_warc": OP12, "op13_collocations": OP13}
