"""The training-data operators against plain versions, with nulls, ties, repeats, long and empty texts."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docsieve.llm import decontaminate, ngram_join, pieces, quality, resample, secrets, shards, substrings, tokenfile, warc

from . import brute

WORDS = "the of and to in is that it was for on are as with his they at be this have from or one had by word but not what all were we when your can said there use an each which she do how their if".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))


def corpus(seed=0):
    """Prose, exact and near copies, shared passages, benchmark items, odd and empty texts, repeated rows."""
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (49, 50, 51, 80, 200)]
    texts = [prose(rng, rng.choice([3, 9, 12, 30, 60, 120, 300])) for _ in range(60)]
    texts += [texts[i] for i in (1, 1, 1, 5, 9)]
    for i in (7, 7, 7, 20, 21, 22):
        w = texts[i].split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [f"{prose(rng, rng.randrange(40))} {rng.choice(shared)} {prose(rng, rng.randrange(40))}" for _ in range(40)]
    texts += ["", None, " \n\t ", "É" * 40, "one", "a b", "x\x0by\x0cz\rq", "日本 語 " * 30, "same " * 400, prose(rng, 30_000), "\x00\x1f odd"]
    texts += ["Password = 'hunter22'; token:abc", "AKIA" + "A1" * 9, "deadbeef" * 4, "api_key\":  \"Zz9+/_.=-\" secret=abcdef0123456789abcdef01", "ghp_" + "a1B2" * 10]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [(None, "null id text of some words here"), (None, shared[4]), (3, "a row that repeats an id"), rows[0], rows[0]]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows, name="doc_id"):
    df = spark.createDataFrame([(d, t, "en" if (d or 0) % 3 else None, f"s{(d or 0) % 2}", 7) for d, t in rows], f"{name} long, text string, lang string, source string, n_words int")
    return df.repartition(3)


def same(df, want, *cols):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=key) == sorted((tuple(r) for r in want), key=key)


def test_decontamination(spark, rows):
    items = [(1, rows[10][1]), (2, "word " * 13), (3, "one had"), (None, prose(random.Random(9), 20)), (5, ""), (6, None), (10, rows[10][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [*rows, (900, f"lead in {items[3][1].upper()} and out")]
    want = brute.contamination(docs, items)
    for limit in (1 << 20, 200):  # broadcast; block files
        out = decontaminate.scan(frame(spark, docs), bench, broadcast_limit=limit)
        out = out.select("doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("s"), decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("c"))
        same(out, want, "*")
    kept = decontaminate.decontaminate(frame(spark, docs), bench)
    same(kept, [d for d, w in zip(docs, want) if not w[5]], "doc_id", "text")
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(frame(spark, docs), bench, remove="spans").collect()}
    assert cut[900] == "lead in " + "" + items[3][1].upper()[len(items[3][1].rstrip("., \n")) :] + " and out"


@pytest.mark.parametrize("n", [1, 2, 13, 16, 17, 25, 50])
def test_windows_of_every_length(n):
    rng = random.Random(n)
    items = [(1, prose(rng, 60)), (2, prose(rng, 12)), (3, prose(rng, 20)), (4, None), (None, prose(rng, 33))]
    docs = [(1, "lead " + items[0][1] + " tail"), (2, items[1][1]), (3, prose(rng, 400)), (4, " ".join(items[4][1].split()[:26]).upper()), (5, None)]
    block = decontaminate.NgramSet(n, [i for i, _ in items], pa.array([t or "" for _, t in items]))
    w = decontaminate.Words(pa.array([t or "" for _, t in docs]), decontaminate.ALNUM_LOW, lower=True)
    hit, found = np.zeros(len(w.start), bool), [set() for _ in docs]
    block.find(w, hit, found)
    got = [(int(hit[a:b].sum()), brute.sha(",".join(sorted(f)))) for a, b, f in zip(w.rows[:-1], w.rows[1:], found)]
    assert got == [(x[2], x[4]) for x in brute.contamination(docs, items, n)]
    assert got[0][0] >= 60


def test_few_keys_are_looked_up_in_place(tmp_path):
    from docsieve.llm._util import RangeReader

    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 50_000).astype(np.uint64))
    perfect = tokenfile.PerfectHash.build(keys)
    entry = np.zeros(len(keys), tokenfile._ENTRY)
    entry["fingerprint"][perfect.slots(keys)] = keys
    path = tmp_path / "index"
    path.write_bytes(perfect.dump() + entry.tobytes())
    with RangeReader(str(path)) as f:
        for some in (keys[:5], keys):
            found, rows = tokenfile.open_index(f, len(some))
            assert (rows[found.slots(some)]["fingerprint"] == some).all() and found.base == perfect.base
            assert isinstance(rows, np.ndarray) == (len(some) > 5)


def test_quality(spark, rows):
    junk = [(1000 + i, " ".join(w + "#$%" for w in prose(random.Random(i), 60).split())) for i in range(8)]
    clean = [(2000 + i, prose(random.Random(100 + i), 150)) for i in range(120)]
    docs = [*rows, *junk, *clean]
    out = quality.judge(frame(spark, docs), carry=["doc_id", "n_words"])
    want = [(d, *brute.quality(t)) for d, t in docs]
    same(out, want, "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    kept = {r.d: r.kept for r in out.select(F.col("row.doc_id").alias("d"), "kept").collect()}
    assert not any(kept[d] for d, _ in junk) and all(kept[d] for d, _ in clean)
    stayed = quality.filter_quality(frame(spark, docs))
    assert stayed.columns == ["doc_id", "text", "lang", "source", "n_words"] and stayed.where("n_words = 7").count() == out.where("kept").count()


def test_repeats_are_exact_without_hashes(spark):
    docs = [(i, t) for i, t in enumerate(["a b c d e f a b c d e", "x " * 40, prose(random.Random(1), 200)])]
    df = quality.base_columns(frame(spark, docs).drop("n_words"), "text")
    assert {r.doc_id: r.n_repeat_words for r in df.collect()} == {d: brute.quality(t)[4] for d, t in docs}
    was = quality._POS
    try:
        quality._POS = 5  # texts of over 31 words take the exact path
        df = quality.base_columns(frame(spark, docs).drop("n_words"), "text")
        assert {r.doc_id: r.n_repeat_words for r in df.collect()} == {d: brute.quality(t)[4] for d, t in docs}
    finally:
        quality._POS = was


@pytest.mark.parametrize("k, numer, leaf", [(3, 90, 2000), (5, 80, 3)])
def test_links(spark, rows, k, numer, leaf, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF_DOCS", leaf)
    rng = random.Random(5)
    base = prose(rng, 200).split(" ")
    near = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randrange(12)):
            w[rng.randrange(200)] = f"v{rng.randrange(1000)}"
        near.append((3000 + i, " ".join(w)))
    docs = [*rows, *near]
    out = ngram_join.link_components(frame(spark, docs), k=k, numer=numer)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "node"]
    same(out, brute.link_components(docs, k, numer, 100), "doc_id", "n_shingles", "component_id")


def test_one_of_each_group_stays(spark, rows):
    kept = ngram_join.keep_one(frame(spark, rows))
    want = [(d, t) for (d, t), (_, n, c) in zip(rows, brute.link_components(rows, 5, 80, 100)) if d is None or c == d]
    ids = {d for d, t in want}
    assert {r.doc_id for r in kept.collect()} == ids and kept.columns == frame(spark, rows).columns


def test_first_shingles_meet():
    """Sets that just link share one of their first shingles, at every size, whatever is known as frequent."""
    rng = np.random.default_rng(0)
    for n in [1, 2, 9, 10, 11, 12, 19, 20, 29, 50, 137, 400, 1500]:
        for numer in (80, 90):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            drop = int(n - np.ceil(numer / 100 * n))
            b = np.sort(a[rng.permutation(n)[drop:]])
            often = np.sort(rng.choice(a, n // 2, replace=False))
            for heavy in ((often, np.arange(len(often)).astype(np.uint8)), (often[:0], np.zeros(0, np.uint8))):
                row, token = ngram_join.first_shingles(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), heavy, numer, 100)
                assert set(token[row == 0].tolist()) & set(token[row == 1].tolist()), n


def test_tree_loses_nothing():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    sets = []
    for i in range(1500):
        own = rng.integers(0, 1 << 63, int(rng.integers(1, 200))).astype(np.uint64)
        sets.append(np.unique(np.concatenate([base[: rng.integers(1, 300)], own[: rng.integers(0, 30)]]) if i % 2 else own))
    size = np.array([len(s) for s in sets])
    pts = ngram_join.points(np.concatenate(sets), np.concatenate([[0], np.cumsum(size)])).astype(np.uint32)
    tree = ngram_join.RTree(pts, size, 80, 100)
    assert len(tree.levels) == 2
    i, j = tree.search(np.arange(1500), np.ones(1500, bool))
    got = {(int(tree.order[x]), int(tree.order[y])) for x, y in zip(i, j)}
    want = set()
    for x in range(1500):
        over = np.minimum(pts[x], pts).sum(1)
        ok = (over >= -(-80 * (size[x] + size) // 180)) & (np.minimum(size, size[x]) * 100 >= 80 * np.maximum(size, size[x]))
        want |= {(x, y) for y in np.flatnonzero(ok).tolist()}
    assert got == want and len(got) > 1500
    up = list(range(1500))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    pairs = list(ngram_join.grow(tree))
    for x, y in pairs:
        assert find(x) != find(y)
        up[find(x)] = find(y)
    assert all(find(x) == find(y) for x, y in want)


def test_links_of_tied_cells(spark, rows, monkeypatch):
    """Rows that stand for many, in every task and cell."""
    monkeypatch.setattr(ngram_join, "STAR", 2)
    same(ngram_join.link_components(frame(spark, rows), k=5, numer=80), brute.link_components(rows, 5, 80, 100), "doc_id", "n_shingles", "component_id")


def test_shards(spark, rows):
    grid = np.array(np.meshgrid(*[np.arange(8)] * 3)).reshape(3, -1)
    h = shards.hilbert(list(grid), 3)
    assert sorted(h) == list(range(512)) and (np.abs(np.diff(grid[:, np.argsort(h)], axis=1)).sum(0) == 1).all()
    docs = frame(spark, rows)
    key = [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")))]
    docs = shards.bucketed(shards.bucketed(docs, "source", "a"), "lang", "b")
    out = shards.assign(docs, [F.col("a"), F.col("b")], key, [F.col("doc_id")], 16).collect()
    per = {}
    for r in out:
        per.setdefault(r.shard, []).append(r.slot)
    assert len(out) == len(rows) and set(per) == set(range(16))
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in per.values())


def test_shard_files(spark, rows, tmp_path):
    docs = frame(spark, rows)
    manifest = shards.write_shards(docs, str(tmp_path / "s"), shards=4)
    assert manifest.agg(F.sum("rows")).first()[0] == len(rows)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(rows)


@pytest.mark.parametrize("lead", ["", "https://www.site-of-"])
def test_manifest_prunes(spark, tmp_path, lead):
    """A predicate on a source or language touches little more than the shards that hold it, whatever the sources begin with."""
    rng = random.Random(13)
    docs = [(i, prose(rng, rng.choice([5, 20, 80, 300])), rng.choice(["de", "en", "fr", None]), f"{lead}{chr(97 + rng.randrange(20))}-site") for i in range(3000)]
    manifest = shards.write_shards(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), str(tmp_path / "s"))
    held = spark.read.parquet(str(tmp_path / "s")).select("source", F.col("__shard").alias("shard")).distinct().collect()
    rows = manifest.collect()
    touched = sum(r.min_source <= s <= r.max_source for s in {h.source for h in held} for r in rows)
    assert touched <= 1.3 * len(held) and touched < 0.5 * 20 * 16


def test_secrets(spark, rows):
    out = {}
    for r in secrets.find_secrets(frame(spark, rows)).collect():
        out.setdefault(r.doc_id, []).append([(x.kind, x.start, x.end) for x in r.spans])
    for d, t in rows:
        base = [",".join(f"{k}:{s}:{e}" for k, s, e in x if k in ("assign", "access", "hex")) for x in out[d]]
        assert brute.secrets(t)[1] in map(brute.sha, base)
    cut = {r.text for r in secrets.redact(frame(spark, rows)).collect()}
    assert "[ASSIGN]'; token:abc" in cut and "[FORGE_TOKEN]" in cut and None in cut


def test_trigram_queries():
    q = {r.kind: secrets.trigram_query(r) for r in secrets.RULES}
    assert q["hex"] is True and q["access"] == ("and", [b"aki", b"kia"])
    assert q["assign"][0] == "or" and all(x[0] == "and" for x in q["assign"][1])
    index = secrets.Index(secrets.RULES)
    texts = pa.array(["AK", "IA" + "A" * 30, "xAKIA" + "B" * 16, "api_KEY=abcdefg", "apikey : 'q1w2e3'"])
    assert [[k for k, _, _ in x] for x in index.spans(texts)] == [[], [], ["access"], ["assign"], ["assign"]]


@pytest.mark.parametrize("block", [600_000, 300])
def test_substrings(spark, rows, block, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_WORDS", block)
    out = substrings.dedup_substrings(frame(spark, rows))
    same(out, brute.substrings(rows), "doc_id", "n_words", "n_removed", "kept_sha256")


def test_index_structures():
    rng = np.random.default_rng(1)
    text = np.concatenate([np.concatenate([rng.integers(1, 6, 90), [0]]) for _ in range(5)] + [np.tile([1, 2], 60), [0]]).astype(np.int64)
    index = substrings.FMIndex(text)
    order = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert index.sa.tolist() == order
    starts = np.arange(len(text) - 50)
    which, lo, hi = index.repeated(starts, 50)
    windows = [tuple(text[i : i + 50]) for i in range(len(text) - 49)]
    want = [i for i in starts.tolist() if windows.count(windows[i]) > 1]
    assert which.tolist() == want and all(windows.count(windows[i]) <= h - a for i, a, h in zip(which.tolist(), lo, hi))


def test_token_files(spark, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    assert t.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    special = ["<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>b\n <|endoftext|>  ", "x<|endoftext|>\n\n y <|endof text|>"]
    odd = [(5000 + i, s) for i, s in enumerate(["a  b", "x  y", "\r\n\r\n z", "it's  12 ", "a\x1c b", *special])]
    docs = [*rows, *odd]
    files = tokenfile.write(frame(spark, docs), path)
    got = tokenfile.checksums(files).orderBy("start").collect()
    ids = {}
    for d, s in docs:
        ids.setdefault(d, []).append([*t.encode(s or "", add_special_tokens=False).ids, 2])
    begin = 0
    for r, d in zip(got, sorted((d for d, _ in docs), key=lambda d: (d is not None, d))):
        assert r.doc_id == d and r.start == begin
        assert r.ids_crc32 in {zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids[d]}
        begin += r.n_tokens
    unknown = spark.createDataFrame([(10**9, 0), (1, 0)], "doc_id long, ordinal long")
    assert [r.doc_id for r in tokenfile.read(files, unknown).collect()] == [1]


def test_perfect_hash():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 20_000).astype(np.uint64)
    h = tokenfile.PerfectHash.build(np.unique(keys))
    slots = h.slots(np.unique(keys))
    assert sorted(slots.tolist()) == list(range(len(np.unique(keys))))
    again, _ = tokenfile.PerfectHash.load(h.dump())
    assert (again.slots(keys) == h.slots(keys)).all()
    assert h.base + len(h.rest) == len(np.unique(keys))
    with pytest.raises(ValueError):
        tokenfile.PerfectHash.build(np.array([1, 1], np.uint64))


def test_warc(spark, tmp_path):
    pages = [(1, "u", "abc"), (2, None, "abc"), (9, "u", "abc"), (3, "u\nx", "é"), (None, "q", None), (5, "u", ""), (5, "u", ""), (None, "n", "only null")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, header int")
    payloads, headers = warc.write_archive(df)
    assert payloads.count() == 4
    got = headers.select(warc.field("X-Page-ID").alias("p"), warc.field("WARC-Type").alias("t"), warc.field("X-Refers-To-Page-ID").alias("r"), warc.field("WARC-Payload-Digest").alias("d"))
    sha = lambda s: "sha1:" + base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()
    want = [("1", "revisit", "9", sha("abc")), ("2", "revisit", "9", sha("abc")), ("9", "response", None, sha("abc")), ("3", "response", None, sha("é")), (None, "revisit", "5", sha("")), ("5", "response", None, sha("")), ("5", "response", None, sha("")), (None, "response", None, sha("only null"))]
    same(got, want, "*")
    small = warc.write_archive(df, least=4)[1].where(warc.field("WARC-Type") == "revisit").count()
    assert small == 0
    folder = f"file://{tmp_path}/w"
    assert warc.export_warc(payloads, headers, folder).agg(F.sum("records")).first()[0] == 8
    back = warc.read_warc(spark, folder)
    whole = {bytes(r.record) for r in warc.records(payloads, headers).collect()}
    assert {r.header.encode() + bytes(r.block) + b"\r\n\r\n" for r in back.collect()} == whole


def test_pieces(spark, rows):
    import sentencepiece

    model = pieces.default_model()
    lib = sentencepiece.SentencePieceProcessor(model_file=model)
    odd = [(6000 + i, s) for i, s in enumerate(["  two  spaces ", "a▁b ▁", "x" * 400, "\t\n\n", "é😀日本", "<s> </s>"])]
    docs = [*rows, *odd]
    out = pieces.decode(pieces.encode(frame(spark, docs), model), model)
    want = [(d, lib.encode(t or ""), (t or "").replace("▁", " ")) for d, t in docs]
    same(out, want, "doc_id", "ids", "decoded")


def test_unigram_paths():
    names = ["<unk>", "▁", "a", "b", "ab", "▁a", "▁ab", "ba", "<0x63>"]
    scores = [0.0, -2.0, -3.0, -3.1, -4.0, -3.5, -9.0, -2.5, 0.0]
    m = pieces.PieceModel(names, scores, [2, 1, 1, 1, 1, 1, 1, 1, 6], bpe=False)
    best = {}

    def cost(s):
        if not s:
            return 0.0, []
        if s not in best:
            ways = [(scores[i] + cost(s[len(p) :])[0], [i, *cost(s[len(p) :])[1]]) for i, p in enumerate(names) if i not in (0, 8) and s.startswith(p)]
            best[s] = max(ways)
        return best[s]

    for t in ("ab", "aba", "abab ab", "bba a"):
        ids, _ = m.rows(pa.array([t]))
        assert sum(scores[i] for i in ids.tolist()) == pytest.approx(cost("▁" + t.replace(" ", "▁"))[0])
    assert m.rows(pa.array(["c"]))[0].tolist()[-1] == 8


def test_resampling(spark):
    rng = random.Random(3)
    good = [(i, prose(rng, 80)) for i in range(200)]
    bad = [(1000 + i, " ".join(rng.choice(["spam", "buy", "click", "free"]) for _ in range(80))) for i in range(60)]
    docs = [*good, *bad, (None, None), (5000, ""), (0, good[0][1])]
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in good[:100]] + [(d, 0, 0) for d, _ in bad[:30]] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    out = resample.resample(frame(spark, docs), labels, share=0.75).collect()
    chosen = {r.doc_id for r in out if r.selected}
    assert len(out) == len(docs) and sum(r.selected for r in out) == round(0.75 * len(docs))
    held = [d for d, _ in good[100:]]
    assert sum(d in chosen for d in held) > 0.9 * len(held) and sum(d in chosen for d, _ in bad[30:]) < 0.2 * 30
    none = resample.resample(frame(spark, docs), labels.where("quality = 7"), share=0.5)
    assert none.where("log_weight != 0").count() == 0


def test_weights_are_ratios_of_two_models(spark):
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.choice([5, 40, 90]))) for i in range(60)] + [(60, None), (61, "")]
    good, buckets = set(range(0, 60, 3)), 512
    per = {}
    for d, t in docs:
        w = brute.LOW_WORD.findall(brute.lower(t))
        b, _ = resample.grams(pa.array([t or ""]), buckets)
        assert len(b) == max(0, 2 * len(w) - 1)
        per[d] = b
    raw = np.bincount(np.concatenate(list(per.values())), minlength=buckets)
    target = np.bincount(np.concatenate([per[d] for d in good]), minlength=buckets)
    lean = resample.LEAN
    p = (target + lean) / (target.sum() + lean * buckets)
    q = (raw + lean * raw.sum() / target.sum()) / (raw.sum() * (1 + lean * buckets / target.sum()))
    assert p.sum() == pytest.approx(1) and q.sum() == pytest.approx(1)
    labels = spark.createDataFrame([(d, 1, 0) for d in good], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in resample.score(frame(spark, docs), labels, buckets=buckets).collect()}
    for d, b in per.items():
        want = np.log(p[b] / q[b]).sum() * resample.SCALE / (len(b) + resample.SHRINK)
        assert got[d].log_weight == pytest.approx(want) and got[d].n_grams == len(b)
        assert got[d].key == pytest.approx(want + resample.gumbel(np.array([d]), resample.SEED)[0])


def test_top_k_by_digits(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 30) for _ in range(500)] + [1.5] * 20
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, key double")
    for k in (0, 1, 17, 250, 519, 520):
        got = {r.key for r in resample.top_k(df, "key", k, ["doc_id"]).where("selected").collect()}
        rows = resample.top_k(df, "key", k, ["doc_id"]).where("selected").count()
        assert rows == k and got == set(sorted(values, reverse=True)[:k])


EMPTY = "doc_id long, text string, lang string, source string"


def test_empty_tables(spark):
    e = spark.createDataFrame([], EMPTY)
    bench = spark.createDataFrame([], "item_id long, text string")
    import public_tokenizers

    assert decontaminate.scan(e, bench).count() == 0
    assert decontaminate.decontaminate(e, bench).count() == 0
    assert quality.judge(e).count() == 0
    assert ngram_join.link_components(e).count() == 0
    assert ngram_join.keep_one(e).count() == 0
    assert secrets.find_secrets(e).count() == 0 and secrets.redact(e).count() == 0
    assert substrings.dedup_substrings(e).count() == 0
    assert pieces.encode(e, pieces.default_model()).count() == 0
    assert tokenfile.checksums(tokenfile.write(e, public_tokenizers.path("byte_bpe_50k.json"))).count() == 0
    payloads, headers = warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.records(payloads, headers).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert resample.resample(e, labels).count() == 0
    assert shards.assign(shards.bucketed(e, "lang", "cell"), [F.col("cell")], [F.col("doc_id")], [F.col("doc_id")]).count() == 0


def test_share_comes_from_labels(spark):
    rng = random.Random(6)
    good = [(i, prose(rng, 80)) for i in range(120)]
    bad = [(1000 + i, " ".join(rng.choice(["spam", "buy", "click", "free"]) for _ in range(80))) for i in range(80)]
    labelled = [(d, 1, 0) for d, _ in good[:60]] + [(d, d % 2, 1 if d % 2 else 0) for d, _ in bad[:40]]
    odd = [(0, 1, 0), (None, 0, 1), (100, None, 0)]
    labels = spark.createDataFrame([*labelled, *odd], "doc_id long, quality int, toxic int")
    assert resample.good_share(labels) == 0.6
    chosen = {r.doc_id for r in resample.resample(frame(spark, [*good, *bad]), labels).where("selected").collect()}
    assert len(chosen) == 120
    assert sum(d in chosen for d, _ in bad[40:]) <= 4 and sum(d in chosen for d, _ in good[60:]) >= 56
    assert resample.good_share(labels.where("quality = 0")) == resample.good_share(labels.where("quality = 7")) == 1.0
