"""SQL for the registered queries, in DuckDB's dialect."""

from __future__ import annotations

_SPACE = r"[\t\n\x0B\f\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
_WORD = r"^([^a-zA-Z0-9]*)(\w+)([^a-zA-Z0-9]*)$"
_STOP = "('that', 'with', 'from', 'this', 'which', 'hent', 'ered')"


def _tokens(source: str = "select doc_id, text from documents", key: str = "doc_id") -> str:
    return rf"""
src as ({source}),
words as (select {key}, unnest(range(1, len(ws) + 1)) as wpos, unnest(ws) as w from (select {key}, regexp_split_to_array(lower(text), '{_SPACE}') as ws from src where text is not null)),
parts as (select {key}, wpos, regexp_extract(w, '{_WORD}', 1) as g1, regexp_extract(w, '{_WORD}', 2) as g2, regexp_extract(w, '{_WORD}', 3) as g3 from words where regexp_matches(w, '{_WORD}')),
tok as (select {key}, row_number() over (partition by {key} order by wpos, k) - 1 as pos, token from (
  select {key}, wpos, 0 as k, '#' as token from parts where g1 <> '' union all select {key}, wpos, 1, g2 from parts union all select {key}, wpos, 2, '#' from parts where g3 <> ''))"""


def _clean(key: str = "doc_id") -> str:
    return rf"""
clean as (select {key}, pos, case when length(token) >= 4 and len(regexp_extract_all(token, '[^a-zA-Z0-9_]')) <= 2 and len(regexp_extract_all(token, '[0-9]')) < 2 and token not in {_STOP} then token else '#' end as token from tok),
size as (select {key}, count(*) as n_tokens from tok group by {key}),
isl as (select {key}, pos, token, pos - row_number() over (partition by {key} order by pos) as island from clean where token <> '#'),
run as (select {key}, island, string_agg(token, ' ' order by pos) as run, count(*) as words from isl group by {key}, island)"""


def _freq(key: str = "doc_id") -> str:
    return rf"""
term as (select {key}, token as term from isl union all select {key}, run from run where words > 1),
counted as (select {key}, term, count(*) as frequency, len(string_split(term, ' ')) as strength from term group by {key}, term),
freq as (select c.* from counted c join size s using ({key}) where strength >= 2 or frequency >= case when n_tokens < 1000 then 1 when n_tokens < 3000 then 4 else 7 end)"""


_TOK = "with" + _tokens()
_CLEAN = _TOK + "," + _clean()
_FREQ = _CLEAN + "," + _freq()
_LEX = "lex as (select * from (values ('the','DT'),('of','IN'),('and','CC'),('that','IN'),('was','VBD'),('is','VBZ'),('are','VBP'),('with','IN'),('from','IN'),('tion','NN'),('thth','JJ'),('oner','JJ'),('hein','VB'),('thin','VB'),('reth','RB'),('inan','NNS')) t(token, tag))"
_LEM = "lem as (select * from (values ('inan','noun','inas'),('thth','adj','th'),('hein','verb','hei'),('was','verb','be'),('reth','adv','re')) t(token, pos_name, lemma))"
_TAGGED = _TOK + f", {_LEX}, tagged as (select t.*, case when token = '#' then '#' else coalesce(tag, 'NND') end as tag from tok t left join lex using (token))"
_LEMMAS = (
    _TAGGED
    + f""", {_LEM},
named as (select *, case when tag = 'RB' then 'adv' when tag = 'JJ' then 'adj' when regexp_matches(tag, 'N[A-Z]{{1,3}}') then 'noun' when regexp_matches(tag, 'V[A-Z]{{1,3}}') then 'verb' end as pos_name from tagged),
lemmas as (select n.*, coalesce(l.lemma, n.token) as lemma from named n left join lem l on n.token = l.token and n.pos_name = l.pos_name)"""
)
_SPEC = (
    _FREQ
    + """,
w as (select * from (values ('tion', 0.02), ('oner', 0.004), ('thth', 0.001), ('hein', 0.0)) t(term, weight)),
prob as (select *, frequency / sum(frequency) over (partition by doc_id) as probability from freq),
raw as (select p.*, probability / case when weight is null or weight = 0 then 1e-5 else cast(weight as double) end as raw from prob p left join w using (term)),"""
)

_SEG_SOURCE = """select *, struct_pack(d := conv_id, s := case when c > 1 then role || ':nth-child(' || r || ')' else role end, o := turn) as key from (
  select *, count(*) over (partition by conv_id, role) as c, row_number() over (partition by conv_id, role order by turn) as r from conversations where turn > 0)"""
_SEG = "with" + _tokens(_SEG_SOURCE, "key") + "," + _clean("key") + "," + _freq("key") + """,
cells as (select key.d as doc_id, key.s as segment, key.o as ord, term, strength, cast(frequency as double) as value from freq)"""
_SEG_F = _SEG + """,
sums as (select *, sum(value) over (partition by doc_id, segment) as rs, sum(value) over (partition by doc_id, term) as cs from cells),
fs as (select *, value / cs as fr, value / rs as fp, 2 * (value / cs) * (value / rs) / (value / cs + value / rs) as ff from sums),
rm as (select doc_id, segment, avg(ff) as row_mean from fs group by doc_id, segment),
cm as (select doc_id, term, avg(ff) as col_mean from fs group by doc_id, term),
mm as (select doc_id, avg(m) as mean from (select doc_id, row_mean as m from rm union all select doc_id, col_mean from cm) group by doc_id)"""

_TITLE = (
    _tokens("select conv_id, text from conversations where turn = 0", "conv_id") + "," + _clean("conv_id") + "," + _freq("conv_id")
).replace("src as", "tsrc as").replace("from src", "from tsrc").replace("words as (select conv", "twords as (select conv").replace("from words where", "from twords where")
for _name in ("parts", "tok", "clean", "size", "isl", "counted", "freq"):
    _TITLE = _TITLE.replace(f"\n{_name} as", f"\nt{_name} as").replace(f"from {_name} ", f"from t{_name} ").replace(f"from {_name})", f"from t{_name})").replace(f"join {_name} ", f"join t{_name} ").replace(f"from {_name} group", f"from t{_name} group")
_TITLE = _TITLE.replace("\nrun as", "\ntrun as").replace("from run where", "from trun where").replace("\nterm as", "\ntterm as").replace("from term group", "from tterm group").replace("from counted c", "from tcounted c").replace("from parts", "from tparts")

_NB = r"""with
occ as (select lang as pool, unnest(regexp_extract_all(text, '(\w+)')) as word from documents),
cnt as (select pool, word, count(*) as n from occ group by pool, word)"""
_PROB = """
{p}x as (select c.pool, c.word, n, sum(n) over (partition by c.word) - n as other, sum(n) over (partition by c.pool) as tokens, sum(n) over () as total from {c} c),
{p}f as (select pool, word, least(1.0, n / greatest(total - tokens, 1)) / (least(1.0, other / tokens) + least(1.0, n / greatest(total - tokens, 1))) as f from {p}x),
{p}m as (select pool, word, least(greatest(f, 0.0001), 0.9999) as p from {p}f where abs(f - 0.5) >= 0.1)"""
_MODEL = _NB + "," + _PROB.format(p="a", c="cnt")
_SCORE = r"""
{s}w as (select item_id, word, count(*) as c from (select item_id, unnest(regexp_extract_all(text, '(\w+)')) as word from {t}) group by item_id, word),
{s}s as (select item_id, pool, cast(sum(c) as bigint) as n, 1 - exp(sum(c * ln(1 - p)) / sum(c)) as pp, 1 - exp(sum(c * ln(p)) / sum(c)) as qq from {s}w join {m} using (word) group by item_id, pool),
{s}g as (select *, (1 + (pp - qq) / (pp + qq)) / 2 as score from {s}s)"""
_SCORES = _MODEL + "," + _SCORE.format(s="s", t="benchmark", m="am")
_BEST = "select * from (select *, row_number() over (partition by item_id order by round(score, 12) desc, pool) as r from {g} where score > 0) where r = 1"

_LANGS = {
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als",
    "en": "the of and to in is that for it as was with be by on not he this are or",
    "es": "de la que el en y los se del las un por con no una su para es al lo",
    "fr": "de la le et les des en un du une que est pour qui dans par plus au ne se",
}
_LANG = r"with ws as (select doc_id, regexp_split_to_array(lower(text), '[^\p{L}]+') as ws from documents), hit as (" + " union all ".join(f"select doc_id, '{c}' as code, len(list_filter(ws, lambda x: x in ({', '.join(repr(w) for w in v.split())}))) as score from ws" for c, v in _LANGS.items()) + """),
tot as (select doc_id, sum(score) as total from hit group by doc_id),
rk as (select *, row_number() over (partition by doc_id order by score desc, code) as r from hit where score > 0),
best as (select ws.doc_id, a.code, cast(floor(100 * a.score / total) as integer) as percent, coalesce(a.score >= 3 and a.score * 2 >= coalesce(b.score, 0) * 3, false) as reliable
  from ws join tot using (doc_id) left join rk a on a.doc_id = ws.doc_id and a.r = 1 left join rk b on b.doc_id = ws.doc_id and b.r = 2)"""

_CAT = """with ident as (select s_suppkey, case when s_suppkey % 7 = 0 then '' when s_suppkey % 5 = 0 then 'none' else cast(s_nationkey as varchar) end as identifier from supplier),
cat as (select i.s_suppkey, r_name, n_name from ident i join nation n on cast(n.n_nationkey as varchar) = i.identifier join region r on r.r_regionkey = n.n_regionkey)"""

_ORD = "with o as (select *, o_orderkey % 11 <> 0 and o_orderkey % 7 <> 0 as ok from orders)"

_HTML = r"(?is)^\s*(<!doctype\s+html|<html)"
_XML = r"^\x{feff}?\s*<\?xml\s"

_PROFILES = r"""
src as (select doc_id, lang, ' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' ' as x from documents where text is not null),
chars as (select doc_id, lang, unnest(string_split(x, '')) as a, generate_subscripts(string_split(x, ''), 1) as i from src),
tri as (select * from (select doc_id, lang, i - 1 as place, a || lead(a) over w || lead(a, 2) over w as gram from chars window w as (partition by doc_id order by i)) where gram is not null),
counts as (select lang as code, gram, count(*) as n from tri where lang is not null group by all),
totals as (select code, sum(n) as total, count(*) as kinds from counts group by code),
profile as (
  select code, gram, cast(round(1000 * ln((n + 1) / (total + kinds))) as bigint) as weight
  from (select *, row_number() over (partition by code order by n desc, gram) as r from counts) join totals using (code) where r <= 2000
  union all select code, '', cast(round(1000 * ln(1 / (total + kinds))) as bigint) from totals)"""


ORACLE_SQL = {
    "walk_folders": "select 'corpus' as corpusname, cast(7 as bigint) as \"startAt\", '.txt' as extension, page_id % 16 as bucket, cast(sum(strlen(coalesce(html, '')) + 1) as bigint) as bytes, cast(sum(length(coalesce(html, '')) + 1) as bigint) as chars from pages group by all",
    "pdf_files": r"""with p as (select conv_id, len(regexp_split_to_array(coalesce(text, '') || chr(10), '\s+')) as w from conversations)
select conv_id, 'application/pdf' as mimetype, 'PDF document, version 1.5' as complete, 'talk ' || conv_id as title, count(*) as pages, cast(sum(w) as bigint) as words, cast(sum(w) // count(*) as bigint) as words_by_page from p group by conv_id""",
    "xml_schema_errors": """select o_orderkey, cast((o_orderkey % 6 = 0)::int + (o_orderkey % 4 = 0)::int + (o_orderkey % 5 = 0)::int as bigint) as n_errors,
  concat_ws(',', case when o_orderkey % 6 = 0 then '2' end, case when o_orderkey % 4 = 0 then '3' end, case when o_orderkey % 5 = 0 then '4' end) as lines from orders""",
    "filetype_bytes": r"""with p as (select page_id, page_id % 12 as k, coalesce(url, '') as url, coalesce(html, '') as html from pages),
x as (select *, 'page été: ' || url as fr, case k when 0 then html when 1 then '%PDF-1.4' || chr(10) || '1 0 obj <<>> endobj' || chr(10) || url || chr(10) || 'trailer <<>>' || chr(10) || '%%EOF' when 2 then '%PDF-1.4 ' || md5(url)
   when 6 then 'page été: ' || url when 7 then 'page été: ' || url when 9 then '<?xml version="1.0"?><a>' || md5(url) || '</a>' when 10 then 'page été: ' || url when 11 then 'plain address: ' || regexp_replace(url, '[^ -~]', '', 'g') end as t from p)
select page_id,
  case k when 0 then case when html = '' then 'application/octet-stream' when regexp_matches(html, '^\s*(<!doctype\s+html|<html)', 'is') then 'text/html' when len(regexp_extract_all(html, '<(?:.|\n)*?>')) > 10 then 'application/xml' else 'text/plain' end
    when 1 then 'application/pdf' when 3 then 'image/png' when 4 then 'application/zip' when 9 then 'application/xml' when 2 then 'application/octet-stream' when 5 then 'application/octet-stream' when 8 then 'application/octet-stream' else 'text/plain' end as mimetype,
  case when k in (3, 4, 5, 8) then 'binary' when k = 6 then 'utf-16le' when k = 11 then 'utf-16be' when k = 7 then 'iso-8859-1' when strlen(t) = length(t) then 'us-ascii' else 'utf-8' end as encoding,
  k in (2, 5) as broken, md5(t) as text_md5 from x""",
    "xml_errors": """select o_orderkey, cast((o_orderkey % 5 = 0)::int + (o_orderkey % 2 = 0)::int * 2 + (o_orderkey % 3 = 0)::int as bigint) as n_errors,
  concat_ws(',', case when o_orderkey % 5 = 0 then '3' end, case when o_orderkey % 2 = 0 then '4' end, case when o_orderkey % 3 = 0 then '6' end, case when o_orderkey % 2 = 0 then '7' end) as lines from orders""",
    "xml_number_regex": r"""with v as (select o_orderkey, o_orderkey % 50 as a, o_custkey % 100 as b, printf('%d.%02d', cast(o_orderkey % 50 as integer), cast(o_custkey % 100 as integer)) as t from orders)
select o_orderkey, case when b > 0 then cast(a as bigint) end as p, b > 0 as "pIsValid", case when b = 0 then cast(a as double) end as "pError", cast(t as double) as q, t as s, t as u from v""",
    "lang_profiles": f"with {_PROFILES} select code, gram, weight from profile",
    "lang_identify": f"""with {_PROFILES},
spans as (select doc_id, place // 200 as span, gram, count(*) as c from tri group by all),
scored as (
  select s.doc_id, s.span, r.code, sum(s.c) as size, sum(s.c * coalesce(p.weight, r.weight)) as score, sum(case when p.weight is not null then s.c else 0 end) as known
  from spans s cross join (select code, weight from profile where gram = '') r left join profile p on p.code = r.code and p.gram = s.gram group by all),
ranked as (select *, row_number() over w as k, score - lead(score) over w as margin from scored window w as (partition by doc_id, span order by score desc, code)),
votes as (select doc_id, case when 2 * known >= size then code else '' end as code, sum(size) as n, sum(case when 2 * known >= size then margin else 0 end) as m from ranked where k = 1 group by all),
shares as (select *, sum(n) over (partition by doc_id) as total from votes),
listed as (select *, row_number() over (partition by doc_id order by n desc, code) as k, count(*) over (partition by doc_id) as languages from shares where code <> '')
select d.doc_id, coalesce(l.n >= 12 and l.m // l.n >= 50 and 2 * l.n >= l.total, false) as reliable, coalesce(least(l.languages, 3), 0) as n_languages, l.code,
       cast(100 * l.n // l.total as bigint) as percent, (l.m // l.n) / 1000 as score
from documents d left join listed l on l.doc_id = d.doc_id and l.k = 1""",
    "walk_file_info": "select 'corpus' as corpusname, cast(0 as bigint) as \"startAt\", '/corpus/doc-' || doc_id || '.txt' as path, 'doc-' || doc_id || '.txt' as name, '.txt' as extension, cast(octet_length(encode(coalesce(text, ''))) as bigint) as size from documents",
    "filetype_detect": rf"""with b as (select 'page' as kind, page_id as id, html as text from pages union all select 'document', doc_id, text from documents),
t as (select *, cast(len(regexp_extract_all(text, '(?s)<.*?>')) as bigint) as tags from b)
select kind, id, case when text is null then 'application/octet-stream' when regexp_matches(split_part(text, chr(10), 1), '{_XML}') then 'application/xml' when regexp_matches(text, '{_HTML}') then 'text/html' when regexp_matches(text, '{_XML}') or tags > 10 then 'application/xml' else 'text/plain' end as mimetype, tags from t""",
    "filetype_encoding": "select doc_id, case when text is null then 'binary' when octet_length(encode(text)) = length(text) then 'us-ascii' else 'utf-8' end as encoding from documents",
    "token_stream": _TOK + " select doc_id, pos, token from tok",
    "token_count": _TOK + " select d.doc_id, cast(coalesce(n, 0) as bigint) as n_tokens from documents d left join (select doc_id, count(*) as n from tok group by doc_id) using (doc_id)",
    "token_sanitize": _CLEAN + " select d.doc_id, cast(coalesce(n, 0) as bigint) as n_tokens, cast(coalesce(s, 0) as bigint) as n_separators from documents d left join (select doc_id, count(*) as n, count(*) filter (token = '#') as s from clean group by doc_id) using (doc_id)",
    "tag_tokens": _TAGGED + " select doc_id, tag, count(*) as n from tagged group by doc_id, tag",
    "lemmatize_tokens": _LEMMAS + " select lemma, pos_name, count(*) as n from lemmas group by lemma, pos_name",
    "multiterm_runs": _CLEAN + " select doc_id, run, count(*) as n from run where words > 1 group by doc_id, run",
    "keyterm_frequency": _FREQ + " select doc_id, term, frequency, strength from freq",
    "keyterm_specificity": _SPEC + " fin as (select doc_id, term, probability, raw / max(raw) over (partition by doc_id) as specificity from raw) select doc_id, term, round(probability, 8) as probability, round(specificity, 8) as specificity from fin",
    "keyterm_ranking": _FREQ + """, sp as (select *, frequency / max(frequency) over (partition by doc_id) as specificity from freq),
av as (select *, avg(specificity) over (partition by doc_id) as mean from sp)
select doc_id, term, frequency, round(specificity, 8) as specificity, row_number() over (partition by doc_id order by round(specificity, 12) desc, term) as rank from av where round(specificity, 12) >= round(mean, 12)""",
    "keyterm_tagged_ranking": _LEMMAS + f""",
clean as (select doc_id, pos, case when length(token) >= 4 and len(regexp_extract_all(token, '[^a-zA-Z0-9_]')) <= 2 and len(regexp_extract_all(token, '[0-9]')) < 2 and lemma not in {_STOP} and (tag like 'N%' or tag like 'J%') then lemma else '#' end as token from lemmas),
size as (select doc_id, count(*) as n_tokens from tok group by doc_id),
isl as (select doc_id, pos, token, pos - row_number() over (partition by doc_id order by pos) as island from clean where token <> '#'),
run as (select doc_id, island, string_agg(token, ' ' order by pos) as run, count(*) as words from isl group by doc_id, island),""" + _freq() + " select doc_id, term, frequency from freq",
    "keyterm_stage_log": _FREQ + """, t as (select doc_id, count(*) as n from term group by doc_id), f as (select doc_id, count(*) as n from freq group by doc_id)
select d.doc_id, case when coalesce(n_tokens, 0) = 0 then 'TOKENIZATION' when t.n is null then 'EXTRACTION' when f.n is null then 'INDEXATION' end as missing
from documents d left join size using (doc_id) left join t using (doc_id) left join f using (doc_id)""",
    "segment_matrix": _SEG + " select doc_id, segment, term, value from cells",
    "segment_fmeasure": _SEG_F + " select doc_id, segment, term, round(fr, 8) as fr, round(fp, 8) as fp, round(ff, 8) as ff, round(mean, 8) as mean from fs join mm using (doc_id)",
    "segment_keywords": _SEG_F + "," + _TITLE + """,
sel as (select fs.*, row_mean, t.term is not null as titled from fs join rm using (doc_id, segment) join mm using (doc_id) left join tfreq t on t.conv_id = fs.doc_id and t.term = fs.term where round(ff, 12) >= round(mean, 12) or t.term is not null)
select doc_id, term, count(*) as n_segments, sum(value) + arg_min(value, ord) as total, round(sum(ff / row_mean) / count(*) + case when bool_or(titled) then 50 else 0 end * count(*) * max(strength), 6) as factor from sel group by doc_id, term""",
    "bayes_counts": _NB + " select pool, word, n from cnt",
    "bayes_probs": _MODEL + " select pool, word, round(p, 8) as p from am",
    "bayes_scores": _SCORES + " select item_id, pool, n, round(score, 6) as score from sg",
    "bayes_guess": _SCORES + f" select item_id, pool, round(score, 6) as score from ({_BEST.format(g='sg')})",
    "bayes_cascade": _SCORES + r""",
occ2 as (select case when source < 'src5' then 'low' else 'high' end as pool, unnest(regexp_extract_all(text, '(\w+)')) as word from documents where lang = 'en'),
cnt2 as (select pool, word, count(*) as n from occ2 group by pool, word),""" + _PROB.format(p="b", c="cnt2") + f""",
first as ({_BEST.format(g='sg')}),
chosen as (select b.item_id, b.text from benchmark b join first f on f.item_id = b.item_id where f.pool = 'en'),""" + _SCORE.format(s="z", t="chosen", m="bm") + f""",
second as ({_BEST.format(g='zg')}),
names as (select * from (values ('en', 'English'), ('low', 'Low sources'), ('high', 'High sources')) t(code, verbalization)),
every as (select item_id, 1 as level, pool as code, score from first union all select item_id, 2, pool, score from second)
select item_id, level, e.code, round(score, 6) as probability, verbalization from every e left join names n on n.code = e.code""",
    "lang_detect": _LANG + " select doc_id, reliable, code, coalesce(percent, 0) as percent from best",
    "lang_gate": _LANG + " select doc_id, coalesce(reliable and percent >= 70 and code = 'en', false) as passes from best",
    "category_lookup": _CAT + " select s_suppkey, 1 as level, r_name as value from cat union all select s_suppkey, 2, n_name from cat",
    "category_abort": _CAT + " select i.s_suppkey, identifier = '' as missing, c.s_suppkey is not null as matched from ident i left join cat c using (s_suppkey)",
    "config_match": "select c_custkey, (select min(f) from (select printf('%02d', r_regionkey) as f from region) where contains(lower(c_name), f)) as folder from customer",
    "xml_metadata": _ORD + """ select o_orderkey,
case when ok and regexp_matches(o_orderstatus, '^[OF]$') then o_orderstatus end as status, case when ok then regexp_matches(o_orderstatus, '^[OF]$') end as "statusIsValid", case when ok and not regexp_matches(o_orderstatus, '^[OF]$') then o_orderstatus end as "statusError",
case when ok then cast(o_orderkey as varchar) end as id, case when ok then 'en' end as lang, case when ok then cast(floor(o_totalprice) as bigint) end as price, case when ok then o_orderkey % 3 = 0 end as "hasPrio", case when ok then cast(4 as bigint) end as elements,
case when ok then case when o_orderkey % 3 = 0 then o_orderpriority else cast(o_custkey as varchar) end end as first from o""",
    "xml_wellformed": _ORD + """ select o_orderkey, ok as "isWellFormed", not ok as "hasErrors", case when o_orderkey % 11 <> 0 then 'order.dtd' end as sysid from o""",
    "xml_dtd_validate": _ORD + """ select o_orderkey, case when ok then o_orderkey % 5 <> 0 end as "isValidAgainstDTD" from o""",
    "css_select_text": _ORD + " select o_orderkey, case when ok then cast(o_custkey as varchar) else '' end as cust, case when ok then o_orderstatus else '' end as status from o",
    "xpath_inventory": """select '/order' as xpath, count(distinct l_orderkey) as "countElement", '' as attributes from lineitem
union all select '/order/line', count(*), case when bool_or(l_returnflag = 'R') then 'no,returned' else 'no' end from lineitem union all select '/order/line/qty', count(*), '' from lineitem""",
    "pdf_word_stats": r"with w as (select conv_id, len(regexp_split_to_array(text, '[\t\n\x0B\f\r \x{feff}]+')) as w from conversations) select conv_id, count(*) as pages, cast(sum(w) as bigint) as words, cast(sum(w) // count(*) as bigint) as words_by_page from w group by conv_id",
    "error_log_rollup": "select case when event_type = 'error' and props is not null then 'error' else 'ok' end as status, event_type, count(*) as n from events group by 1, 2",
    "bundle_batches": "select doc_id, (row_number() over (order by doc_id) - 1) // 64 as bundle from documents",
    "out_json": "select doc_id, doc_id as id, lang, source, n_chars from documents",
    "enrichment_render": "select doc_id, '<doc id=''' || doc_id || ''' lang=''' || lang || '''><p>' || source || '</p><p>' || n_chars || '</p></doc>' as rendered from documents",
}

# The same results through sessions: turns are segments of one name there.
ORACLE_SQL |= {
    "session_bayes": ORACLE_SQL["bayes_cascade"],
    "session_segments": ORACLE_SQL["segment_keywords"].replace("role || ':nth", "'turn' || ':nth").replace("else role end", "else 'turn' end").replace("partition by conv_id, role", "partition by conv_id"),
    "sink_xpaths": ORACLE_SQL["xpath_inventory"],
    "session_validation": _ORD + """ select o_orderkey, case when ok then case when o_orderkey % 5 = 0 then 'free' else 'priced' end end as valid_dtd,
case when ok then case when o_orderkey % 5 = 0 then 'priced' else 'free' end end as broken_dtd, case when ok then cast(1 as bigint) end as n_errors from o""",
}
