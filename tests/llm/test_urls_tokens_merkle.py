"""URL filter, token alignment and Merkle manifest against brute force, on rows
with NULLs, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 97}x{i % 13}" for i in range(4000))
DOCS = [
    (1, "Hello world, don't\n\nworry\n", "src0", "en", 24), (2, None, "src0", "en", None), (3, "", None, None, 0),
    (4, "a▁b", "src1", "de", 3), (5, "straße 日本語 🙂 naïve\tx", None, "de", 20), (None, "no id here\n", "src0", "", 11),
    (6, LONG, "src0", "en", len(LONG)), (7, "two words", "src0", "en", 9), (7, "two words", "src0", "en", 9),
    (7, "other\nwords", "src0", "en", 11), (8, "<|endoftext|> <s> plain </s>", "-", "en", 28), (9, "   ", "Zürich", "en", 3),
    (10, "nul\0 byte\r\n", "a", "en", 11), (11, "the the the the", "src0", "fr", 15), (12, "x" * 3000, "src0", "fr", 3000),
    (13, "alone", "", "fr", 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame([(i, t, s, g, n) for i, t, s, g, n in DOCS],
                              "doc_id long, text string, source string, lang string, n_chars long").repartition(3)
    for name in ("leaf", "tree", "idx", "row", "codes", "payload", "hash", "level", "place", "n", "grp"):
        d = d.withColumn(name, F.lit("x"))
    return d


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- token alignment

def _encoders():
    import sentencepiece
    from tokenizers import Tokenizer
    from starforge.llm.token_alignment import BYTE_BPE, PIECE_BPE, byte_letters
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    letters = byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)

    def a_tokens(t):
        e = a.encode(" " + t, add_special_tokens=False)
        return e.ids, [bytes(letters[c] for c in x) for x in e.tokens]

    def b_tokens(t):
        ids = b.encode(t)
        return ids, [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else
                     b.id_to_piece(i).replace("▁", " ").encode() for i in ids]
    return a_tokens, b_tokens


def _spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def _alignment(rows):
    """Plain version: every pair of tokens is compared."""
    a_tokens, b_tokens = _encoders()
    docs, total = [], Counter()
    for i, t in rows:
        (a, ab), (b, bb) = (a_tokens(t), b_tokens(t)) if t else (([], []), ([], []))
        if not t or b"".join(ab) != (" " + t).encode() or b"".join(bb) != (" " + t).encode():
            a, ab, b, bb = [], [], [], []
        sa, sb = _spans(ab), _spans(bb)
        links, first = [], 0
        for x, (s, e) in zip(a, sa):
            while first < len(sb) and sb[first][1] <= s:
                first += 1
            k = first
            while k < len(sb) and sb[k][0] < e:
                links.append((x, b[k]))
                k += 1
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        for e in ends:
            groups.append(",".join(str(x) for x, p in zip(a, sa) if low <= p[0] < e) + "|"
                          + ",".join(str(y) for y, p in zip(b, sb) if low <= p[0] < e))
            low = e
        total.update(links)
        docs.append((i, len(a), len(b), len(ends), links, ";".join(groups)))
    high = Counter()
    for (_, y), n in total.items():
        high[y] = max(high[y], n)
    return [(i, na, nb, ng, len(ls), sum(total[p] == high[p[1]] for p in ls), sum(total[p] for p in ls),
             hashlib.sha256(g.encode()).hexdigest() if na else "") for i, na, nb, ng, ls, g in docs]


@pytest.mark.parametrize("heavy", [1, 50, 100_000])
def test_token_alignment(spark, docs, heavy):
    from starforge.llm.token_alignment import alignment_report
    assert _rows(alignment_report(docs, heavy=heavy)) == sorted(_alignment([r[:2] for r in DOCS]), key=repr)


def test_token_alignment_of_given_documents(spark, sf_small):
    from starforge.llm import queries
    from starforge.llm.common import table
    d = [(r.doc_id, r.text) for r in table(spark, sf_small, "documents").select("doc_id", "text").collect()]
    assert _rows(queries.op12_token_alignment(spark, sf_small)) == sorted(_alignment(d), key=repr)


def test_alignment_states_groups_and_pairs(spark, docs):
    from starforge.llm.token_alignment import align
    got = {r.doc_id: r for r in align(docs).collect()}
    assert got[4].n_a == 0 and got[4].groups == "" and got[4].pairs == []
    r = got[11]
    assert sum(p.links for p in r.pairs) == r.n_links and len(r.groups.split(";")) == r.n_groups


def test_byte_side_equals_the_file_s_own_tokenizer():
    """Letters, digits, marks, spaces of all planes, each in several surroundings."""
    from starforge.llm.token_alignment import BYTE_BPE, byte_side, read_byte_bpe
    a_tokens, _ = _encoders()
    side = byte_side(read_byte_bpe(BYTE_BPE)[0])
    r = np.random.default_rng(2)
    for _ in range(300):
        c = [chr(x) for x in r.integers(1, 0x20000, 40) if not 0xD800 <= x < 0xE000] + [" ", "\n", "'ll", " 12", "\u3000"]
        t = "".join(c[i] for i in r.integers(0, len(c), 60))
        assert side.encode([t])[0].tolist() == a_tokens(t)[0]


# ---- Merkle manifest

def _h(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def _manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(i, t, s, g, n):
        return _h(*(field(v) for v in (i, s, g, n, t)))

    def tree(nodes):
        """Root and, for each node, (left, right) at each level."""
        ways = [[] for _ in nodes]
        under = [[k] for k in range(len(nodes))]
        while len(nodes) > 1:
            above, over = [], []
            for k in range(0, len(nodes), 3):
                part = nodes[k:k + 3]
                for j in range(len(part)):
                    for m in under[k + j]:
                        ways[m].append(("".join(part[:j]), "".join(part[j + 1:])))
                above.append(_h(*part))
                over.append([m for u in under[k:k + 3] for m in u])
            nodes, under = above, over
        return nodes[0], ways
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[2] == s), key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf(*r))))
        trees[s] = (own, *tree([leaf(*r) for r in own]))
    root, tops = tree([trees[s][1] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        own, sub, ways = trees[s]
        for r, way in zip(own, ways):
            i, t, src, g, n = r
            even = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
            node = leaf(i, t.replace("\n", "") if even and t is not None else t, src, g, n)
            for left, right in way + top:
                node = _h(left, node, right)
            out.append((i, leaf(*r), sub, root, _h(*(a + b for a, b in way + top)), node, node == root))
    return out


@pytest.mark.parametrize("levels", [1, 6])
def test_merkle_manifest(spark, docs, levels, monkeypatch):
    from starforge.llm import merkle_manifest as m
    monkeypatch.setattr(m.build, "__defaults__", (m.FANOUT, levels))
    got = _rows(m.manifest_report(docs))
    assert got == sorted(_manifest(DOCS), key=repr)
    assert {r[6] for r in got} == {True, False}


def test_merkle_manifest_of_deep_trees(spark):
    """A source with 2,500 leaves (8 levels), others with 1 to 4; both join paths."""
    from starforge.llm import merkle_manifest as m
    rows = [(i, f"t{i}\n", "hot" if i < 2500 else f"s{i % 40}", "en", i) for i in range(2570)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    want = sorted(_manifest(rows), key=repr)
    assert _rows(m.manifest_report(d)) == want
    small = m.SMALL_ROWS
    try:
        m.SMALL_ROWS = 0
        assert _rows(m.manifest_report(d)) == want
    finally:
        m.SMALL_ROWS = small


# ---- URL filter

URLS = [
    (1, None), (2, ""), (3, "no scheme/here"), (4, "http://"), (5, "https://A.Example.NET/en/x?q=1#f"), (6, "http://net"),
    (7, "http://net/"), (8, "x://notnet/"), (9, "http://example.com/de/"), (10, "http://sub.example.com/de"),
    (11, "http://z.org/fr/a://b"), (12, "http://example.net/en/"), (12, "http://example.net/en/"), (None, "http://m.net/en/"),
    (13, "HTTP://a.b/" + "p/" * 3000), (14, "http://h\nost/a\nb?c\n#d"),
]


def _want_url(u):
    if u is None or "://" not in u:
        return "", "", None, None
    rest = u.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    base = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    fit = [(len(h + p), h + p, v) for h, p, v in base if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fit)[1:] if fit else (None, None))


def test_url_rules(spark):
    from starforge.llm.url_filter import url_filter
    d = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("tokens", F.lit(2))
    got = _rows(url_filter(d).select("page_id", "host", "path", "rule", "verdict"))
    want = [(i, h, p, r, v or "allow") for i, u in URLS for h, p, r, v in [_want_url(u)]]
    assert got == sorted(want, key=repr)
    assert url_filter(d.filter("false")).count() == 0


def test_mined_url_rules(spark):
    """Mined rules against plain counting of all sets of up to three tokens."""
    from itertools import combinations

    from starforge.llm.url_filter import match_rules, mine_rules
    r = np.random.default_rng(6)
    names = [f"p:{c}" for c in "abcdefgh"]
    rows = []
    for i in range(400):
        t = {x for x in names if r.random() < 0.35}
        bad = {"p:a", "p:b"} <= t or "p:c" in t and r.random() < 0.95
        t |= {"q:u", "q:v"} if r.random() < 0.3 else set()         # always together
        rows.append((i, sorted(t | {"h:all"}), "block" if bad else "allow"))
    d = spark.createDataFrame(rows, "row long, tokens array<string>, label string")
    rules = mine_rules(d, min_support=0.02, min_confidence=0.9)
    sets = {}
    for _, t, label in rows:
        t = [x for x in t if x not in ("h:all", "q:v")]
        for k in (1, 2, 3):
            for s in combinations(t, k):
                sets.setdefault(s, Counter())[label] += 1
    base = Counter(x[2] for x in rows)
    mined = {(s, v): n / sum(c.values()) for s, c in sets.items() for v, n in c.items()
             if n >= 8 and n / sum(c.values()) >= 0.9 and n / sum(c.values()) > base[v] / 400}
    kept = {(tuple(sorted(s + (("q:v",) if "q:u" in s else ()))), v): c for (s, v), c in mined.items() if not any(
        w == v and set(o) < set(s) and oc >= c for (o, w), oc in mined.items())}
    assert {(tuple(x.tokens), x.label): x.confidence for x in rules.collect()} == kept and kept
    best = {tuple(x.tokens): x for x in match_rules(d, rules).collect()}
    for _, t, _ in rows:
        fit = [(c, v) for (s, v), c in kept.items() if set(s) <= set(t)]
        assert (tuple(t) in best) == bool(fit) and (not fit or best[tuple(t)].confidence == max(fit)[0])


def test_url_filter_learns_from_labels(spark):
    from starforge.llm.url_filter import url_filter
    rows = [(i, f"http://site{i % 7}.com/{'spam' if i % 2 else 'news'}/{i}") for i in range(200)]
    d = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, "block" if i % 2 else "allow") for i in range(100)] + [(5, None)],
                                   "page_id long, label string")
    got = {x.page_id: x.verdict for x in url_filter(d, labels=labels).collect()}
    assert got == {i: "block" if i % 2 else "allow" for i, _ in rows}


def test_empty_tables(spark, docs):
    from starforge.llm.merkle_manifest import manifest_report
    from starforge.llm.token_alignment import alignment_report
    empty = docs.filter("false")
    assert alignment_report(empty).count() == 0 and manifest_report(empty).count() == 0
