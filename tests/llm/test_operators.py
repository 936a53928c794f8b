"""Operators against brute force on a small table with NULLs, empty and long
texts, ties, repeated rows and extra columns with clashing names."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]


def _text(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(r.integers(0, 10, n), r.integers(0, 9, n)))


PASSAGE = _text(99, 40)
LONG = _text(5, 3000)
ROWS = [
    (1, "", "en", "src1"), (2, None, "en", "src1"), (None, PASSAGE, "en", None), (3, PASSAGE, "de", "src2"),
    (4, "zürich " + PASSAGE + " ünd more", None, "src2"), (5, _text(1, 60) + " " + PASSAGE, "en", "src3"),
    (6, _text(2, 120), "en", "src0"), (7, _text(2, 120) + " one", "en", "src0"), (8, _text(2, 118), "en", "src0"),
    (9, LONG, "en", "src0"), (9, LONG, "en", "src0"), (10, "two words", "fr", "src4"), (11, "two words", "fr", "src4"),
    (12, PASSAGE + " " + PASSAGE, "es", "src5"), (13, "x " * 60, "es", "src5"), (14, "   \n\t ", "es", "x"),
    (15, "The MIT License and the Apache License.\n" + PASSAGE, "en", "src1"),
    (16, "Licensed under the Apache License, Version 2.0", "en", "src1"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").repartition(3)
    # extra columns whose names the operators use themselves
    return (df.withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("score", F.lit(None).cast("int"))
            .withColumn("node", F.lit("n")).withColumn("w", F.lit(0)).withColumn("n_chars", F.length("text").cast("long")))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _ws(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_quality_rules(spark, docs):
    from starforge.llm.quality_rules import quality_rules

    def want(i, t):
        w = _ws(t)
        g = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        rep = {p for k, x in enumerate(g) if g.count(x) > 1 for p in (k, k + 1, k + 2)} if len(w) < 1000 else None
        lines = [x for x in (t or "").split("\n") if _ws(x)]
        return (i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)),
                None if rep is None else len(rep))
    got = quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.when(
        F.col("n_words") < 1000, F.col("n_repeat_words")), "base_failed")
    got = _rows(got)
    assert [g[:6] for g in got] == sorted((want(i, t) for i, t, *_ in ROWS), key=repr)
    assert all(g[6] for g in got if g[1] < 50)


def test_license_scan(spark, docs):
    from starforge.llm.license_scan import license_scan
    got = {r.doc_id: r for r in license_scan(docs).collect()}
    assert (got[15].n_base, got[15].first_word, got[15].last_word, got[15].base_labels) == (2, 1, 5, "apache,mit")
    assert got[16].labels == "apache" and got[16].score == 1.0
    assert got[2].n_words == 0 and got[2].first_word is None and got[2].labels == "" and got[2].score == 0


def test_minhash_dedup(spark, docs):
    from starforge.llm.minhash_dedup import minhash_dedup
    to_lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def shingles(t):
        w = _ws((t or "").translate(to_lower))
        return {tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))} if w else set()
    ids = sorted({i for i, *_ in ROWS if i is not None})
    sets = {i: shingles(t) for i, t, *_ in ROWS if i is not None}
    root = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    want = [(i, len(shingles(t)), root.get(i), True if i is None else root[i] == i) for i, t, *_ in ROWS]
    assert _rows(minhash_dedup(docs)) == sorted(want, key=repr)


def _windows(texts, n, cut):
    """(id, start) -> window, in order of id then start; NULL ids last."""
    first = {}
    for i, t in sorted(texts, key=lambda x: (x[0] is None, x[0] or 0)):
        seq = cut(t)
        for k in range(len(seq) - n + 1):
            first.setdefault(tuple(seq[k:k + n]), (i, k))
    return first


def test_substring_dedup(spark, docs):
    from starforge.llm.substring_dedup import removed_length, substring_dedup
    texts = [(i, t) for i, t, *_ in ROWS]
    first = _windows(texts, 20, _ws)

    def want(i, t):
        w = _ws(t)
        gone = {p for k in range(len(w) - 19) for p in range(k, k + 20) if first[tuple(w[k:k + 20])] != (i, k)}
        return (i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    got = substring_dedup(docs, keep=["kept", "lang"]).select("doc_id", "n_words", removed_length(), "kept", "rest.lang")
    got = _rows(got)
    assert [g[:4] for g in got] == sorted((want(i, t) for i, t in texts), key=repr)
    assert sorted(map(str, (g[4] for g in got))) == sorted(str(r[2]) for r in ROWS)


def _suffix_want(texts, width=50):
    low = {}
    for i, t in texts:
        b = (t or "").encode()
        for k in range(len(b) - width + 1):
            x = b[k:k + width]
            v = np.inf if i is None else i
            low[x] = min(low.get(x, np.inf), v)
    out = []
    for i, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            if low[b[k:k + width]] < (np.inf if i is None else i):
                gone[k:k + width] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), spans, bytes(np.frombuffer(b, np.uint8)[~gone]).hex()))
    return out


@pytest.mark.parametrize("hot,chunk", [(4096, 1 << 20), (1, 1 << 9)])
def test_suffix_dedup_by_chunks(spark, docs, hot, chunk, monkeypatch):
    from starforge.llm import passages
    from starforge.llm.suffix_dedup import suffix_dedup
    monkeypatch.setattr(passages, "CHUNK_BYTES", chunk)
    got = suffix_dedup(docs, hot=hot).select("doc_id", "n_bytes", F.size("spans"), F.lower(F.hex("kept")))
    assert _rows(got) == sorted(_suffix_want([(i, t) for i, t, *_ in ROWS]), key=repr)


def test_merged_transforms_against_brute_force():
    from starforge.llm.suffix_dedup import smallest_by_window
    r = np.random.default_rng(3)
    base = bytes(r.integers(97, 99, 400).astype(np.uint8))
    strings = [base[a:a + int(n)] for a, n in zip(r.integers(0, 300, 60), r.integers(20, 80, 60))]
    ids = r.integers(0, 50, 60)
    got, at = smallest_by_window(strings, ids, 20, shard_bytes=200)
    for s, p in zip(strings, at):
        for k in range(len(s) - 19):
            assert got[p + k] == min(i for i, t in zip(ids, strings) if s[k:k + 20] in t)


def test_a_minimizer_of_many_chunks_is_split():
    """400 chunks of 200 different strings around one minimizer: no bucket takes
    the memory of all, and every window is judged as before."""
    import tracemalloc
    from types import SimpleNamespace

    from starforge.llm.passages import mixed
    from starforge.llm.suffix_dedup import deal, judge_bucket, seed_hashes
    r = np.random.default_rng(1)
    letters = lambda n: r.integers(97, 123, n).astype(np.uint8)      # noqa: E731
    seeds = [letters(16) for _ in range(20_000)]
    lowest = min(seeds, key=lambda x: seed_hashes(x)[0])
    hot = mixed(seed_hashes(lowest) + np.uint64(1))
    left, right = [bytes(letters(40)) for _ in range(40_000)], [bytes(letters(40)) for _ in range(40_000)]
    texts = [[left[r.integers(40_000)] + lowest.tobytes() + right[r.integers(40_000)] for _ in range(200)] for _ in range(400)]

    def sent(mark):
        rows = {}
        for number, t in enumerate(texts):
            n = np.array([len(x) for x in t])
            blob = b"".join(t)
            c = SimpleNamespace(number=number, blob=blob, bytes=np.frombuffer(blob, np.uint8), lengths=n, ends=np.cumsum(n),
                                starts=np.cumsum(n) - n, ids=np.arange(200) + 200 * number)
            for bucket, chunk, data in deal(c, lambda h: np.where(h == hot, mark, 0), 16, 50):
                if bucket >= 0:
                    rows.setdefault(bucket, []).append((chunk, data))
        return rows

    def judged(rows):
        gone, peak = set(), 0
        for got in rows.values():
            tracemalloc.start()
            out = judge_bucket([n for n, _ in got], [d for _, d in got], 50)
            peak = max(peak, tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
            for chunk, data in zip(out.column("chunk").to_pylist(), out.column("data").to_pylist()):
                lo, hi = np.frombuffer(data, np.uint32).reshape(2, -1)
                gone |= {(chunk, int(p)) for a, b in zip(lo, hi) for p in range(a, b)}
        return gone, peak
    split, peak = judged(sent(2))
    assert peak < 60e6 and split == judged(sent(1))[0] and split


def test_language_id(spark, docs):
    from starforge.llm.language_id import init_params, language_id, loss_and_grad
    got = {(r.doc_id, r.lang_pred) for r in language_id(docs).collect()}
    assert (2, "und") in got and (1, "und") in got and (14, "und") in got
    p = {k: v.astype(np.float64) for k, v in init_params(3, hidden=3).items()}
    x, y = np.random.default_rng(1).integers(0, 256, (6, 4)), np.array([0, 1, 2, 1])
    _, grad = loss_and_grad(p, x, y)
    for k in p:         # gradients against differences
        i = tuple(np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape))
        step = {}
        for sign in (1, -1):
            q = {a: b.copy() for a, b in p.items()}
            q[k][i] += sign * 1e-4
            step[sign] = loss_and_grad(q, x, y)[0]
        assert abs((step[1] - step[-1]) / 2e-4 - grad[k][i]) < 1e-5


def test_language_held_out(spark, sf_small):
    from starforge.llm.common import table
    from starforge.llm.language_id import language_id
    d = table(spark, sf_small, "documents")
    got = language_id(d).filter("held_out").join(d.select("doc_id", "lang"), "doc_id")
    ok, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert ok >= 0.95 * n


def test_toxicity(spark, docs):
    from starforge.llm.toxicity import automaton, drop_toxic, folder, match, toxicity
    fold = folder()
    assert fold("ІDIОT! m0r0n ＳＣＵＭ tr@sh?") == " idiot moron scum trash "
    a = automaton({" tras": 2.0, " scum ": 1.0}, [" trash can "])
    assert match(a, fold("trash can"))[:2] == (0, 0)
    assert match(a, fold("trashy scum"))[:2] == (3.0, 2)
    rows = [(i, _text(i, 30) + (" you vile moron" if i % 3 == 0 else ""), i % 3 == 0) for i in range(300)]
    many = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(7, None)], "doc_id long, toxic int")
    got = {x.doc_id: x.predicted for x in toxicity(many, labels).collect()}
    assert got == {i: int(y) for i, _, y in rows}
    assert drop_toxic(many, labels).count() == sum(not y for *_, y in rows)
    none = toxicity(docs, labels.filter("false"))
    assert {(x.score, x.predicted) for x in none.collect()} == {(0.0, 0)} and none.count() == len(ROWS)


def test_sentencepiece_round_trip(spark, docs):
    from starforge.llm.sentencepiece_codec import Encoder, load_vocabulary, sp_report
    got = sp_report(docs).collect()
    assert len(got) == len(ROWS) and all(r.round_trip for r in got)
    assert {r.n_pieces for r in got if r.doc_id in (1, 2)} == {0}
    vocab = load_vocabulary()
    e = Encoder(vocab)
    scores = {vocab["pieces"][i]: vocab["scores"][i] for i in vocab["normal"]}
    for s in ["▁the", "▁hest", "▁retitioning", "▁日本x", "▁▁a", "ünd", "▁" + "x" * 30]:
        best = [(0.0, 0)] + [None] * len(s)         # plain dynamic program
        for end in range(1, len(s) + 1):
            for k in range(end):
                piece = s[k:end]
                cost = scores.get(piece, e.unknown if end - k == 1 else None)
                if cost is not None and (best[end] is None or best[k][0] + cost > best[end][0]):
                    best[end] = (best[k][0] + cost, k)
        got = sum(scores.get(vocab["pieces"][i], 0.0) for i in e.run(s) if i not in vocab["bytes"])
        unknown = sum(1 for c in s if c not in scores and not any(c in p for p in scores))
        assert got + unknown * e.unknown == pytest.approx(best[-1][0])


def test_decoding_needs_no_second_python_worker(spark, docs):
    """The pieces' bytes joined as they stand, with a lone byte piece (no valid
    text) replaced as Python does; only the encoder runs in Python."""
    from starforge.llm.sentencepiece_codec import load_vocabulary, piece_bytes, sp_decode, sp_report
    vocab = load_vocabulary()
    table, lone = piece_bytes(vocab), [vocab["bytes"][b] for b in (0x20, 0xE6, 0x97, 0x41, 0xFF, 0xC3)]
    ids = [None, [], [vocab["normal"][0]], lone, lone[2:], *np.random.default_rng(1).integers(0, len(table), (20, 30)).tolist()]
    got = sp_decode(spark.createDataFrame(list(enumerate(ids)), "doc_id int, ids array<int>"), vocab).collect()
    assert {r.doc_id: r.decoded for r in got} == {
        i: None if x is None else b"".join(table[k] for k in x)[1:].decode("utf-8", "replace") for i, x in enumerate(ids)}
    assert sp_report(docs, vocab)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_whole_texts_against_the_plain_program():
    from starforge.llm.sentencepiece_codec import Encoder, load_vocabulary
    texts = [t for _, t, *_ in ROWS if t and "\0" not in t and "▁" not in t][:40] + ["  two  spaces ", "x\ny\n", "日本 語 x"]
    for rule in ("fewest", "file"):
        vocab = load_vocabulary(scores=rule)
        e = Encoder(vocab)
        scores = {vocab["pieces"][i]: vocab["scores"][i] for i in vocab["normal"]}
        widest = max(map(len, scores))
        by_id, bytes_of = vocab["scores"], set(vocab["bytes"])
        for t in texts:
            s = "▁" + t.replace(" ", "▁")
            best = [0.0]
            for end in range(1, len(s) + 1):
                best.append(max(best[k] + scores.get(s[k:end], e.unknown if end - k == 1 else -np.inf)
                                for k in range(max(0, end - widest), end)))
            ids = e.encode(t)
            unknown, k = 0, 0
            raw = [vocab["bytes"].index(i) if i in bytes_of else None for i in ids]
            while k < len(raw):                 # a run of byte pieces stands for one character
                if raw[k] is None:
                    k += 1
                else:
                    unknown += 1
                    k += 1 if raw[k] < 0x80 else 2 if raw[k] < 0xE0 else 3 if raw[k] < 0xF0 else 4
            total = sum(by_id[i] for i in ids if i not in bytes_of) + unknown * e.unknown
            assert total == pytest.approx(best[-1], rel=1e-12)


def test_fewest_pieces_come_near_the_files_own_encoder():
    import sentencepiece
    from starforge.llm.sentencepiece_codec import MODEL, Encoder, load_vocabulary
    vocab = load_vocabulary()
    e, sp = Encoder(vocab), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert [vocab["pieces"][i] for i in e.encode("the training data pipeline")] == ["▁the", "▁training", "▁data", "▁pipeline"]
    words = sorted({w for _, t, *_ in ROWS for w in (t or "").split() if "▁" not in w and "\0" not in w})
    assert all(len(e.encode(w)) <= len(sp.encode(w)) for w in words if w.isascii())


def test_encoder_marks_and_nul(spark):
    from starforge.llm.sentencepiece_codec import Encoder, load_vocabulary, piece_bytes
    vocab = load_vocabulary()
    e, table = Encoder(vocab), piece_bytes(vocab)
    for t in ["a▁b", "\0", "a\0 b▁", " lead  two", "\n\n", "𝒳 é"]:
        assert b"".join(table[i] for i in e.encode(t))[1:].decode() == t


def test_mixing(spark, docs):
    from starforge.llm.mixing import mix, mix_rows
    got = mix(docs, budget_share=0.5)
    total = sum(len(_ws(t)) for _, t, *_ in ROWS)
    assert got.agg(F.sum("tokens")).first()[0] <= 0.5 * total
    assert got.filter("epoch > 2").count() == 0
    back = mix_rows(docs, budget_share=0.5)
    assert back.columns == docs.columns and back.count() == got.count()
    assert mix(docs.filter("false")).count() == 0


def test_share_out_fills_siblings_first(spark):
    from starforge.llm.mixing import share_out
    n = spark.createDataFrame([("p", "a", 10.0, 1.0, 90.0), ("p", "b", 100.0, 1.0, 90.0), ("p", "c", 30.0, 1.0, 90.0),
                               ("q", "a", 5.0, 2.0, 90.0)], "parent string, node string, capacity double, weight double, budget double")
    got = {(r.parent, r.node): r.share for r in share_out(n, ["parent"], "node").collect()}
    assert got == {("p", "a"): 10.0, ("p", "b"): 50.0, ("p", "c"): 30.0, ("q", "a"): 5.0}


def test_embedding_dedup(spark):
    from starforge.llm.embedding_dedup import audit_recall, embedding_dedup
    r = np.random.default_rng(4)
    base = r.normal(size=(40, 8))
    vec = [(i, (base[i % 40] + (0.05 if i < 600 else 0) * r.normal(size=8)).tolist()) for i in range(900)]
    odd = [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] + [1.0] * 7), (1003, [None] + [1.0] * 7),
           (None, base[0].tolist()), (5, vec[5][1])]
    df = spark.createDataFrame(vec + odd, "vec_id long, embedding array<double>")
    out = embedding_dedup(df)
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in out.collect()}
    x = np.array([v for _, v in vec])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    right = sum(got[i][0] == link[i].sum() for i in range(900))
    assert right >= 0.95 * 900 and all(got[i][0] <= link[i].sum() for i in range(900))
    assert all(got[i] == (0, i, True) for i in (1000, 1001, 1002, 1003)) and got[None][0] == 0
    assert out.count() == len(vec) + len(odd)
    found, there = audit_recall(spark.createDataFrame(vec, "vec_id long, embedding array<double>"), out)
    assert found >= 0.9 * there
    assert embedding_dedup(df.filter("false")).count() == 0


def test_embedding_dedup_of_a_large_group(spark):
    """10,000 different near copies: about 25 shards, most pairs across shards."""
    from starforge.llm.embedding_dedup import embedding_dedup
    r = np.random.default_rng(8)
    x = np.concatenate([r.normal(size=(1, 16)) + 0.05 * r.normal(size=(10_000, 16)), r.normal(size=(500, 16))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {v.vec_id: (v.n_links, v.component_id) for v in embedding_dedup(df).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.95).sum(1) - 1
    links = np.array([got[i][0] for i in range(len(x))])
    assert (want[:10_000] > 9_000).all() and (links <= want).all()
    assert links.sum() >= 0.999 * want.sum()
    assert all(got[i][1] == 0 for i in range(10_000))


def test_embedding_search_tasks_are_bounded(spark, monkeypatch):
    """One shard over many parts, with visitors: no task holds more than a part
    and a block, and every query meets every part."""
    from starforge.llm import embedding_dedup as ed
    monkeypatch.setattr(ed, "PART_ROWS", 50)
    rows = [(i.to_bytes(16), 1, b"", 0, [0], b"", i < 1000) for i in range(1600)]
    dealt = spark.createDataFrame(rows, "node binary, w long, raw binary, shard int, shards array<int>, seen binary, "
                                        "member boolean")
    graph = dealt.select("node", F.array().cast("array<binary>").alias("near"))
    tasks = ed.search_tasks(ed.blocks_of(dealt), graph)
    per = tasks.groupBy("shard", "part", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("own") == F.col("block")).cast("int")).alias("asking")).collect()
    assert len(per) == 20 * 32 and max(x.n for x in per) <= 4 * 50
    assert sum(x.asking for x in per) == 20 * 1600


def test_empty_tables(spark, docs):
    from starforge.llm.license_scan import license_scan
    from starforge.llm.minhash_dedup import minhash_dedup
    from starforge.llm.quality_rules import quality_rules
    from starforge.llm.substring_dedup import substring_dedup
    from starforge.llm.suffix_dedup import suffix_dedup
    empty = docs.filter("false")
    for op in (license_scan, minhash_dedup, quality_rules, substring_dedup, suffix_dedup):
        assert op(empty).count() == 0


def test_pipeline_stages(spark, docs):
    """Stage by stage against the operators' definitions on the small table."""
    import corpus_pipeline as cp
    d = docs
    one = cp.keep_one_of_near_copies(spark, d, None)
    assert one.columns == d.columns
    ids = [r.doc_id for r in one.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 3, 5, 6, 8, 9, 10, 13, 14, 16] and None in ids
    cut = cp.cut_repeated_passages(spark, d, None)
    want = {(i, None if t is None else bytes.fromhex(k).decode("utf-8", "ignore")) for (i, t, *_), (_, _, _, k)
            in zip(ROWS, _suffix_want([(i, t) for i, t, *_ in ROWS]))}
    assert {(r.doc_id, r.text) for r in cut.collect()} == want and cut.columns == d.columns
    pieces = cp.encode_pieces(spark, d, None)
    assert pieces.count() == len(ROWS)
    assert [n for n, _ in cp.STAGES][0] == "toxicity"


def test_minhash_dedup_by_other_shingles_and_threshold(spark):
    from starforge.llm.minhash_dedup import minhash_dedup, rule_for
    assert rule_for(3, 85) == (3, 85, 7, 2, 16)
    rows = []
    for k, more in enumerate([80, 97, 102, 120]):       # five-word similarity 0.832, 0.803, 0.795, 0.767
        words = [f"w{i}x{k}" for i in range(400 + more)]
        rows += [(2 * k, " ".join(words[:400])), (2 * k + 1, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.kept) for r in minhash_dedup(df, shingle=5, percent=80).collect()}
    assert {i for i, (_, kept) in got.items() if kept} == {0, 2, 4, 5, 6, 7} and got[0][0] == 396
    assert {r.doc_id for r in minhash_dedup(df).filter("kept").collect()} == set(range(8))


def test_rows_that_share_an_id_belong_together(spark):
    """Id 5 on two texts, each also at a smaller id: no text's smallest id is 5."""
    from starforge.llm.minhash_dedup import minhash_dedup
    a, b = _text(21, 50), _text(22, 50)
    df = spark.createDataFrame([(5, a), (5, b), (3, a), (4, b)], "doc_id long, text string")
    got = [(r.doc_id, r.component_id, r.kept) for r in minhash_dedup(df).collect()]
    assert sorted(got) == [(3, 3, True), (4, 3, False), (5, 3, False), (5, 3, False)]


def test_toxicity_counts_do_not_depend_on_tasks(spark):
    """A clean word of six documents, about one a task, becomes an exception."""
    import zlib

    from starforge.llm.toxicity import learn
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2][:600]    # not held out
    rows = [(i, _text(i, 30) + (" vile moron" if k < 200 else " vileness" if k < 206 else ""), int(k < 200))
            for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert " vile" in model["lexicon"] and " vileness " in model["exceptions"]


def test_pipeline_keeps_a_text_over_null(spark):
    import corpus_pipeline as cp
    df = spark.createDataFrame([(1, None), (1, "some words"), (2, None)], "doc_id long, text string")
    got = cp.keep_one_of_near_copies(spark, df, None).collect()
    assert sorted(tuple(r) for r in got) == [(1, "some words"), (2, None)]


def test_sql_oracles(spark, con, sf_small):
    from starforge.compare import compare
    from starforge.llm import queries
    for name, sql in queries.oracle_sql().items():
        r = compare(queries.queries()[name](spark, sf_small), con, sql)
        assert r["rows_match"] and r["columns_match"] and r["values_match"], (name, r)


def test_toxicity_matches_against_every_pair():
    """One sweep over hits and exceptions equals looking at all pairs, and 16,000
    words take well under a second."""
    import random
    import time

    from starforge.llm.toxicity import automaton, match
    lexicon = {" ab": 1.0, " abc ": 2.0, " ca": 0.5, " b ": 4.0}
    exceptions = [" abc ab ", " cab ", " b ab", " ab b ca "]
    a, pick = automaton(lexicon, exceptions), random.Random(3)

    def spans(text, p):
        return [(i, i + len(p)) for i in range(len(text)) if text.startswith(p, i)]

    for _ in range(300):
        text = " " + " ".join(pick.choice(["ab", "abc", "b", "ca", "cab", "x"]) for _ in range(pick.randint(0, 30))) + " "
        shield = [s for p in exceptions for s in spans(text, p)]
        hits = [(s, w, p) for p, w in lexicon.items() for s in spans(text, p)
                if not any(x <= s[0] and s[1] <= y for x, y in shield)]
        assert match(a, text) == (sum(w for _, w, _ in hits), len(hits), len({p for *_, p in hits}))
    long = " " + "abc ab b ca " * 4000
    t0 = time.perf_counter()
    match(a, long)
    assert time.perf_counter() - t0 < 1.0


def _links_of(x):
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    return link


def test_embedding_vectors_of_any_length(spark):
    """Finite vectors whose squares leave the range of doubles link as any others;
    the audit passes over vectors that cannot link."""
    from starforge.llm.embedding_dedup import audit_recall, embedding_dedup
    b = np.random.default_rng(2).normal(size=(2, 8))
    x = np.concatenate([[b[0], 1e-200 * b[0], 1e200 * b[0], 2 * b[0]], [1e300 * b[1], -1e300 * b[1]]])
    rows = [(50 * i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1050, [0.0] * 8), (1100, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = embedding_dedup(df)
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert [got[50 * i] for i in range(6)] == [(3, 0)] * 4 + [(0, 200), (0, 250)]
    assert got[1000] == (0, 1000) and got[1050] == (0, 1050)
    assert audit_recall(df, out) == (12, 12)


def test_embedding_links_count_at_both_ends(spark, monkeypatch):
    """Shards of several parts with visitors: the links of all vectors sum to twice
    a whole number of links, none too many, and agree with brute force."""
    from starforge.llm import embedding_dedup as ed
    monkeypatch.setattr(ed, "PART_ROWS", 64)
    monkeypatch.setattr(ed, "SHARD_ROWS", 150)
    r = np.random.default_rng(12)
    base = r.normal(size=(30, 12))
    x = np.concatenate([base[i % 30] + 0.1 * r.normal(size=(1, 12)) for i in range(900)]
                       + [base[0] + 0.12 * r.normal(size=(600, 12))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>")
    df = df.withColumn("node", F.lit("clash")).withColumn("raw", F.lit(1))
    got = {v.vec_id: v.n_links for v in ed.embedding_dedup(df).collect()}
    links, want = np.array([got[i] for i in range(len(x))]), _links_of(x).sum(1)
    assert (links <= want).all() and links.sum() % 2 == 0
    assert links.sum() >= 0.999 * want.sum()


def test_byte_labels_against_a_plain_loop():
    """The pooled probabilities of the batched pass equal a loop over one text's
    bytes and units, forwards and backwards."""
    import math

    from starforge.llm.language_id import byte_probs, init_params, segments
    p = init_params(3, hidden=4, seed=9)
    texts = [b"a", b"some words of a text", "düne, été".encode(), b"", bytes(range(256))]
    x, owner, used = segments(texts, 32)
    got = byte_probs(p, x, used)

    def sig(v):
        return 1 / (1 + math.exp(-v))

    def states(d, row):
        w, u, b = (p[k + d].astype(float) for k in "WUb")
        h, out = [0.0] * 4, []
        for byte in row:
            pre = [w[i, byte] + b[i, 0] for i in range(12)]
            rec = [sum(u[i, j] * h[j] for j in range(4)) for i in range(12)]
            new = []
            for i in range(4):
                z, r = sig(pre[i] + rec[i]), sig(pre[4 + i] + rec[4 + i])
                cand = math.tanh(pre[8 + i] + r * rec[8 + i])
                new.append((1 - z) * cand + z * h[i])
            h = new
            out.append(h)
        return out

    for k, row in enumerate(x.tolist()):
        ahead, back = states("f", row), states("b", row[::-1])[::-1]
        want = np.zeros(3)
        for t in range(used[k]):
            e = np.exp(p["V"].astype(float) @ np.array(ahead[t] + back[t]) + p["c"])
            want += e / e.sum()
        assert np.allclose(got[k], want, atol=1e-3)
        assert abs(got[k].sum() - used[k]) < 1e-3
    assert sorted(set(owner.tolist())) == [0, 1, 2, 4] and used.sum() == sum(map(len, texts))


def test_empty_tables_of_learned_operators(spark, docs):
    from starforge.llm.language_id import language_id
    from starforge.llm.toxicity import drop_toxic, toxicity
    empty, labels = docs.filter("false"), spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity(empty, labels).count() == 0 and drop_toxic(empty, labels).count() == 0
    assert language_id(empty).count() == 0


def test_short_notices_need_all_their_words(spark):
    from starforge.llm.license_scan import license_scan
    texts = ["the film was released last year under the new broadcasting license of the council",
             "Licensed under the Eclipse License version 2.0 only", "Licensed under the BSD License, Version 2.0",
             "released under the MIT license", "Licensed under the Apache License, Version 2.0"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.labels for r in license_scan(df).orderBy("doc_id").collect()] == ["", "", "", "mit", "apache"]
