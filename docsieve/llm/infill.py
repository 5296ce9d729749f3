"""Fill-in-the-middle transformation by escaped marker injection, with DataFrame functions only.

A unit is ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: a word with the white space
before it, or white space at the end.  A delimiter is escaped in the text, one replacement
appends it after every unit, counting it gives the number of units, and ``substring_index``
cuts the parts by rank; parts are unescaped and put together with the sentinels.

Cuts and forms come from a digest of the seed and the id, so that they do not depend on
partitions, order or retries.  Nothing is shuffled: every row is a projection of its own.

Defined cases: a null text is the empty text; an empty text, or one that holds a sentinel
already, stays plain; a null id takes part as the empty string; rows with equal id get equal
cuts; other columns stay, but for those the result names, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import keyed, read_table

SEED = 42
#: Of 100 documents so many are transformed, and of 100 of these so many with the suffix first.
RATE, SPM = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_MARK, _ESCAPE = "\x01", "\x02"


def _replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escape(c: Column) -> Column:
    """The text without the delimiter; neither it nor what stands for it is white space, so units stay whole."""
    return _replace(_replace(c, _ESCAPE, _ESCAPE + "a"), _MARK, _ESCAPE + "b")


def unescape(c: Column) -> Column:
    """A run of marked units as its text."""
    return _replace(_replace(_replace(c, _MARK, ""), _ESCAPE + "b", _MARK), _ESCAPE + "a", _ESCAPE)


def _draw(digest: Column, i: int) -> Column:
    """The i-th group of eight digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def split_parts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``docs`` with n (units), form (plain, psm or spm), prefix, middle and suffix (null if plain)."""
    own = ("n", "form", "prefix", "middle", "suffix")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))), 256)
    out = docs.drop(*own).withColumns({"__text": t, "__marked": F.regexp_replace(escape(t), F.lit(UNIT), F.lit("$0" + _MARK)), "__digest": digest})
    out = out.withColumns({"n": (F.length("__marked") - F.length(_replace(F.col("__marked"), _MARK, ""))).cast("long"), **{f"__h{i + 1}": _draw(F.col("__digest"), i) for i in range(4)}})
    cuts = [F.col(f"__h{i}") % (F.col("n") + 1) for i in (1, 2)]
    taken = F.lit(False)
    for s in (PREFIX, SUFFIX, MIDDLE):
        taken = taken | F.contains("__text", F.lit(s))
    plain = (F.col("__text") == "") | taken | (F.col("__h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("__h4") % 100 < spm, "spm").otherwise("psm")
    out = out.withColumns({"form": form, "__from": F.least(*cuts).cast("int"), "__to": F.greatest(*cuts).cast("int")})
    first = lambda c, k: F.call_function("substring_index", c, F.lit(_MARK), k)
    prefix = first(F.col("__marked"), F.col("__from"))
    middle = first(first(F.col("__marked"), F.col("__to")), F.col("__from") - F.col("__to"))
    suffix = first(F.col("__marked"), F.col("__to") - F.col("n").cast("int") - 1)
    cut = F.col("form") != "plain"
    out = out.withColumns({"prefix": F.when(cut, unescape(prefix)), "middle": F.when(cut, unescape(middle)), "suffix": F.when(cut, unescape(suffix))})
    return out.drop("__text", "__marked", "__digest", "__h1", "__h2", "__h3", "__h4", "__from", "__to")


def assemble(text: Column, form: Column, prefix: Column, middle: Column, suffix: Column) -> Column:
    """The training text of a form."""
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(F.coalesce(text, F.lit("")))


def restore(output: Column, form: Column) -> Column:
    """The original text, from the training text and its form alone.

    A transformed text holds each sentinel once, as texts that held one stayed plain."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    lead = lambda first, second: (_replace(F.substring_index(head, second, 1), first, ""), F.substring_index(head, second, -1))
    prefix, suffix = lead(PREFIX, SUFFIX)
    suffix2, prefix2 = lead(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix2, middle, suffix2)).otherwise(output)


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``docs`` with n, form, prefix, middle, suffix and output, the text to train on."""
    parts = split_parts(docs.drop("output"), doc_id, text, seed, rate, spm)
    return parts.withColumn("output", assemble(F.col(f"`{text}`"), F.col("form"), F.col("prefix"), F.col("middle"), F.col("suffix")))


def op11(spark, sf_dir: str) -> DataFrame:
    """Query over all of ``documents``."""
    out = transform(keyed(read_table(spark, sf_dir, "documents"), "doc_id", "text"))
    sha = lambda c: F.sha2(c, 256)
    chars = lambda c: F.length(c).cast("long")
    return out.select("doc_id", "n", "form", chars("prefix").alias("prefix_chars"), chars("middle").alias("middle_chars"), sha(F.col("output")).alias("output_sha256"), sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = r"""
with t as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
         sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
d as (
  select *, len(u) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2, cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from t),
p as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from d),
c as (
  select *, coalesce(array_to_string(u[1:a], ''), '') as pre, coalesce(array_to_string(u[a + 1:b], ''), '') as mid, coalesce(array_to_string(u[b + 1:], ''), '') as suf from p)
select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
       sha256(case form when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid else text end) as output_sha256,
       sha256(case when form = 'plain' then text else pre || mid || suf end) as restored_sha256
from c"""
