"""Language ID: a bidirectional gated recurrent network over bytes.

Two GRUs (one from the left, one from the right) read the UTF-8 bytes of a
segment of ``SEGMENT`` bytes; a softmax over both states labels every byte, and
a document's language is the mean of its bytes' probabilities.  Trained in
numpy by backpropagation through time on a bounded sample (``DOCS_PER_LANG``
documents of each language, ``SEGMENTS_PER_DOC`` segments of each); applied to
every byte of every text in one scan, the weights (a few kB) shipped with the
job.

Defined results: NULL text, or one without a letter: ``und`` with score 0;
NULL languages are not learned; with no language to learn from every text is
``und``.  Repeated rows repeat their result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import held_out, id_text

DOCS_PER_LANG, SEGMENTS_PER_DOC = 300, 3
HIDDEN, SEGMENT, TRAIN_SEGMENT = 8, 128, 64
STEPS, BATCH, RATE, SEED = 300, 64, 0.01, 7


def init_params(n_langs: int, hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p = {"V": r.normal(0, 0.3, (n_langs, 2 * hidden)), "c": np.zeros(n_langs)}
    for d in "fb":                      # forward and backward GRU
        p[f"W{d}"] = r.normal(0, 0.3, (3 * hidden, 256))
        p[f"U{d}"] = r.normal(0, 0.3, (3 * hidden, hidden))
        p[f"b{d}"] = np.zeros((3 * hidden, 1))
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def gru_states(p: dict, d: str, x: np.ndarray, tape: list | None = None) -> np.ndarray:
    """States (T, H, B) after each byte of ``x`` (T, B), in reading order.
    Gates: rows 0..H update, H..2H reset, 2H..3H candidate."""
    h_ = p[f"U{d}"].shape[1]
    table, u, bias = p[f"W{d}"] + p[f"b{d}"], p[f"U{d}"], 0
    t_, b_ = x.shape
    h = np.zeros((h_, b_), np.float32)
    out = np.empty((t_, h_, b_), np.float32)
    for t in range(t_):
        g, uh = table[:, x[t]], u @ h
        zr = _sigmoid(g[:2 * h_] + uh[:2 * h_])
        z, r = zr[:h_], zr[h_:]
        n = np.tanh(g[2 * h_:] + r * uh[2 * h_:])
        if tape is not None:
            tape.append((h, z, r, n, uh[2 * h_:]))
        h = n + z * (h - n)
        out[t] = h
    return out


def gru_backward(p: dict, d: str, x: np.ndarray, tape: list, dout: np.ndarray, grad: dict) -> None:
    h_ = p[f"U{d}"].shape[1]
    u = p[f"U{d}"]
    dh = np.zeros_like(dout[0])
    for t in range(len(x) - 1, -1, -1):
        h, z, r, n, uhn = tape[t]
        dh = dh + dout[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * uhn * r * (1 - r)
        pre = np.concatenate([dz, dr, dn])              # into table and bias
        into = np.concatenate([dz, dr, dn * r])         # into U h
        grad[f"U{d}"] += into @ h.T
        grad[f"b{d}"] += pre.sum(1, keepdims=True)
        np.add.at(grad[f"W{d}"].T, x[t], pre.T)
        dh = dh * z + u.T @ into


def loss_and_grad(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean cross entropy over all bytes of ``x`` (T, B), labels ``y`` (B,)."""
    h_ = p["Uf"].shape[1]
    tf, tb = [], []
    hf = gru_states(p, "f", x, tf)
    hb = gru_states(p, "b", x[::-1], tb)[::-1]
    both = np.concatenate([hf, hb], axis=1)                          # T, 2H, B
    logit = np.einsum("kh,thb->tkb", p["V"], both) + p["c"][:, None]
    prob = np.exp(logit - logit.max(1, keepdims=True))
    prob /= prob.sum(1, keepdims=True)
    t_, b_ = x.shape
    loss = -np.log(np.maximum(prob[:, y, np.arange(b_)], 1e-12)).mean()
    prob[:, y, np.arange(b_)] -= 1
    prob /= t_ * b_
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    grad["V"] = np.einsum("tkb,thb->kh", prob, both)
    grad["c"] = prob.sum((0, 2))
    dboth = np.einsum("kh,tkb->thb", p["V"], prob)
    gru_backward(p, "f", x, tf, dboth[:, :h_], grad)
    gru_backward(p, "b", x[::-1], tb, dboth[::-1, h_:], grad)
    return float(loss), grad


def train(x: np.ndarray, y: np.ndarray, n_langs: int, steps: int = STEPS, seed: int = SEED) -> dict:
    """Adam on segments ``x`` (N, T) with labels ``y`` (N,): ``steps`` batches,
    whatever the size of the sample."""
    p = init_params(n_langs, seed=seed)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    r, step = np.random.default_rng(seed), 0
    while step < steps:
        order = r.permutation(len(x))
        for i in range(0, len(x), BATCH)[:steps - step]:
            pick = order[i:i + BATCH]
            _, g = loss_and_grad(p, np.ascontiguousarray(x[pick].T), y[pick])
            step += 1
            norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
            for k in p:
                a = g[k] * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * a
                v[k] = 0.99 * v[k] + 0.01 * a * a
                p[k] = (p[k] - RATE * (m[k] / (1 - 0.9 ** step))
                        / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return p


def segments(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the texts cut into rows of ``size`` (the last row of a text
    padded with spaces): rows, the text of each row, bytes in each row."""
    lengths = np.array([len(t) for t in texts], np.int64)
    rows = -(-lengths // size)
    flat = np.frombuffer(b"".join(t.ljust(int(r) * size) for t, r in zip(texts, rows)), np.uint8)
    owner = np.repeat(np.arange(len(texts)), rows)
    used = np.full(len(owner), size, np.int64)
    last = np.cumsum(rows) - 1
    has = rows > 0
    used[last[has]] = lengths[has] - (rows[has] - 1) * size
    return flat.reshape(-1, size), owner, used


def byte_probs(p: dict, x: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Sum over a row's bytes of the label probabilities: (rows, languages)."""
    xt = np.ascontiguousarray(x.T)
    h_ = p["Uf"].shape[1]
    hf = gru_states(p, "f", xt)
    total = np.zeros((len(p["c"]), x.shape[0]), np.float32)
    table, u = p["Wb"] + p["bb"], p["Ub"]
    h = np.zeros((h_, x.shape[0]), np.float32)
    vf, vb, c = p["V"][:, :h_], p["V"][:, h_:], p["c"][:, None]
    for t in range(len(xt) - 1, -1, -1):
        g, uh = table[:, xt[t]], u @ h
        zr = _sigmoid(g[:2 * h_] + uh[:2 * h_])
        n = np.tanh(g[2 * h_:] + zr[h_:] * uh[2 * h_:])
        h = n + zr[:h_] * (h - n)
        e = np.exp(vf @ hf[t] + vb @ h + c)
        total += e * ((t < used) / e.sum(0))
    return total.T


def doc_probs(p: dict, texts: list[bytes], rows_at_once: int = 4096) -> np.ndarray:
    """Mean label probabilities of each text (zeros where it is empty)."""
    x, owner, used = segments(texts, SEGMENT)
    out = np.zeros((len(texts), len(p["c"])))
    for i in range(0, len(x), rows_at_once):
        s = slice(i, i + rows_at_once)
        np.add.at(out, owner[s], byte_probs(p, x[s], used[s]))
    return out / np.maximum(1, [[len(t)] for t in texts])


def learn(docs: DataFrame, lang_col: str = "lang") -> dict | None:
    """Languages and network from the labelled sample; None without labels."""
    lab = (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       docs[lang_col].cast("string").alias("lang"))
           .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))))
    langs = sorted(r["lang"] for r in lab.select("lang").distinct().collect())
    if not langs:
        return None
    # per language the documents with the smallest hashes, segments only
    ids = [lab.filter(F.col("lang") == x).select("doc_id", F.xxhash64("doc_id").alias("h"))
           .orderBy("h", "doc_id").limit(DOCS_PER_LANG) for x in langs]
    chosen = ids[0]
    for more in ids[1:]:
        chosen = chosen.unionByName(more)
    sample = lab.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")

    def cut_out(batches):
        for b in batches:
            x, y = [], []
            for text, lang in zip(b["text"], b["lang"]):
                t = text.encode()
                starts = np.linspace(0, max(0, len(t) - TRAIN_SEGMENT), SEGMENTS_PER_DOC).astype(int)
                for s in sorted(set(starts.tolist())):
                    x.append(t[s:s + TRAIN_SEGMENT].ljust(TRAIN_SEGMENT))
                    y.append(lang)
            yield pd.DataFrame({"x": x, "lang": y})

    got = sample.mapInPandas(cut_out, "x binary, lang string").toPandas().sort_values(["lang", "x"])
    x = np.frombuffer(b"".join(map(bytes, got["x"])), np.uint8).reshape(-1, TRAIN_SEGMENT)
    y = np.searchsorted(langs, got["lang"].to_numpy(str))
    return {"langs": langs, "params": train(x, y, len(langs))}


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                model: dict | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    d = id_text(docs, id_col, text_col)
    model = model or learn(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"),
                                       docs[lang_col].alias("lang")))

    def predict(batches):
        for b in batches:
            texts = [t if t is not None and any(map(str.isalpha, t)) else "" for t in b["text"]]
            out = pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": "und", "score": 0.0})
            if model:
                prob = doc_probs(model["params"], [t.encode() for t in texts])
                best = prob.argmax(1)
                has = np.array([bool(t) for t in texts], bool)
                names = np.array(model["langs"], object)[best]
                out["lang_pred"] = np.where(has, names, "und")
                out["score"] = np.where(has, np.clip(prob[np.arange(len(best)), best], 0, 1), 0.0)
            yield out

    out = d.mapInPandas(predict, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
