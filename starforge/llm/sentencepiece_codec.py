"""SentencePiece encoding and decoding.

A vocabulary of pieces with scores is read from a model file (a parameter, read
on the driver; the pieces travel with the job).  A merge-rank file gives ranks,
not log-probabilities: their sum prefers early short merges ("▁t", "he" for
"▁the").  ``scores="fewest"`` (the rule unless told otherwise) has each piece cost
one and ``TIE`` of its rank, so that the fewest pieces win and, among equally
few, the earlier merges; ``scores="file"`` takes the scores as they stand, for
files of log-probabilities.  Nothing is trained.

A text is normalised (a space in front, spaces as U+2581) and cut into the pieces
with the highest sum of scores: one Aho-Corasick automaton over the pieces reads the text once; at each
position it names, longest first, the pieces that end there (the output links),
and each relaxes the best score of its end from that of its start.  A character
no piece covers costs ``UNKNOWN`` below the lowest score and is written as byte
pieces.

No piece has U+2581 after another character, so a text falls into independent
runs before each U+2581; runs are encoded once per task and remembered.  A
U+2581 of the text itself is written as bytes, which makes decoding an exact
inverse.

Defined results: NULL text: NULL ids, 0 pieces; empty text: no pieces.  Equal
scores: the longest last piece wins.  Repeated rows repeat their result.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import id_text
from starforge.llm.minhash_dedup import portions

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
TIE = 1e-9              # of a rank, against a piece (ranks of 30,000 pieces in a run stay below one)
UNKNOWN = 10.0          # an uncovered character costs this below the lowest score
REMEMBER = 200_000      # runs remembered at a time in a task (forgotten all at once)


def load_vocabulary(path: str = MODEL, scores: str = "fewest") -> dict:
    """Pieces, scores (by the rule named) and byte pieces of a model file."""
    import sentencepiece
    if scores not in ("fewest", "file"):
        raise ValueError(f"scores: fewest or file, not {scores}")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, values, byte_ids = [], [], [0] * 256
    normal = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        pieces.append(piece)
        values.append(sp.get_score(i))
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            normal.append(i)
    if any(re.search(f"[^{SPACE}]{SPACE}", pieces[i]) for i in normal):
        raise ValueError("a piece goes on past a space: runs are not independent")
    if scores == "fewest":      # pieces outside the merges (runs of spaces) count as the last rank
        values = [-1 + TIE * max(v, -len(pieces)) for v in values]
    return {"pieces": pieces, "scores": values, "bytes": byte_ids, "normal": normal}


class Encoder:
    """Viterbi over the automaton's matches, one run at a time."""

    def __init__(self, vocab: dict):
        import ahocorasick
        self.bytes = vocab["bytes"]
        self.automaton = ahocorasick.Automaton()
        for i in vocab["normal"]:
            self.automaton.add_word(vocab["pieces"][i], (len(vocab["pieces"][i]), vocab["scores"][i], i))
        self.automaton.make_automaton()
        self.unknown = min(vocab["scores"][i] for i in vocab["normal"]) - UNKNOWN
        alone = "" if any("\n" in vocab["pieces"][i] for i in vocab["normal"]) else "\n"
        # runs: spaces and what follows up to the next space, apart from
        # characters that stand in no piece; "\0" marks a U+2581 of the text
        self.runs = re.compile(f"{SPACE}+[^{SPACE}{alone}\0]*|[^{SPACE}{alone}\0]+|[{alone}\0]")
        self.seen: dict[str, list[int]] = {}

    def run(self, s: str) -> list[int]:
        if s == "\0":
            return [self.bytes[b] for b in SPACE.encode()]
        n = len(s)
        best, back, piece = [0.0] + [None] * n, [0] * (n + 1), [-1] * (n + 1)
        done = 0                # best scores up to here are final
        for end, (length, score, i) in self.automaton.iter(s):
            end += 1
            while done < end - 1:           # characters no match ended at
                done += 1
                self._unknown(best, back, piece, done)
            start = end - length
            got = best[start] + score
            if best[end] is None or got > best[end]:
                best[end], back[end], piece[end] = got, start, i
            if length == 1:
                done = end                  # the shortest match comes last
        while done < n:
            done += 1
            self._unknown(best, back, piece, done)
        out, end = [], n
        while end:
            start = back[end]
            if piece[end] >= 0:
                out.append(piece[end])
            else:
                out.extend(self.bytes[b] for b in reversed(s[start:end].encode()))
            end = start
        return out[::-1]

    def _unknown(self, best, back, piece, end):
        got = best[end - 1] + self.unknown
        if best[end] is None or got > best[end]:
            best[end], back[end], piece[end] = got, end - 1, -1

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if "\0" in text:        # a NUL of the text is no mark: encode around it
            parts = text.split("\0")
            out = self.encode_marked(" " + parts[0])
            for p in parts[1:]:
                out.append(self.bytes[0])
                out.extend(self.encode_marked(p))
            return out
        return self.encode_marked(" " + text)

    def encode_marked(self, text: str) -> list[int]:
        seen, out = self.seen, []
        for s in self.runs.findall(text.replace(SPACE, "\0").replace(" ", SPACE)):
            ids = seen.get(s)
            if ids is None:
                if len(seen) >= REMEMBER:
                    seen.clear()
                ids = self.run(s)
                if len(s) < 64:
                    seen[s] = ids
            out += ids
        return out


def piece_bytes(vocab: dict) -> list[bytes]:
    """The bytes each id stands for; control pieces stand for none."""
    out = [b""] * len(vocab["pieces"])
    for i in vocab["normal"]:
        out[i] = vocab["pieces"][i].replace(SPACE, " ").encode()
    for b, i in enumerate(vocab["bytes"]):
        out[i] = bytes([b])
    return out


def encode_udf(vocab: dict):
    """Text -> ids."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocab)
        for texts in batches:
            yield pd.Series([None if t is None else np.array(encoder.encode(t), np.int32) for t in texts],
                            dtype=object)
    return F.pandas_udf(run, "array<int>")


def sp_encode(docs: DataFrame, vocab: dict | None = None, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """doc_id, text, ids (array of int) of every row."""
    vocab = vocab or load_vocabulary()

    def run(batches):
        encoder = Encoder(vocab)
        for b in (p for whole in batches for p in portions(whole)):     # small outputs
            ids = [None if t is None else np.array(encoder.encode(t), np.int32)
                   for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"),
                                              pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "text", "ids"])
    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, text string, ids array<int>")


def sp_decode(encoded: DataFrame, vocab: dict | None = None, ids_col: str = "ids") -> DataFrame:
    """The input's columns and ``decoded``, the text the ids stand for: the
    pieces' bytes are looked up and joined as hex digits by Spark itself, so
    that no second Python worker stands beside the encoder's."""
    vocab = vocab or load_vocabulary()
    table = F.split(F.lit(",".join(b.hex() for b in piece_bytes(vocab))), ",")
    digits = F.array_join(F.transform(ids_col, lambda i: F.element_at(table, i + 1)), "")
    whole = F.unhex(F.substring(digits, 3, 2 ** 31 - 1))        # without the space in front
    return encoded.withColumn("decoded", F.make_valid_utf8(whole.cast("string")))


def sp_report(docs: DataFrame, vocab: dict | None = None) -> DataFrame:
    """Per row: pieces, byte pieces, a digest of the ids, and whether decoding
    gives the text back."""
    vocab = vocab or load_vocabulary()
    low, high = min(vocab["bytes"]), max(vocab["bytes"])
    if sorted(vocab["bytes"]) != list(range(low, high + 1)):
        raise ValueError("byte pieces are expected to have consecutive ids")
    d = sp_decode(sp_encode(docs, vocab), vocab)
    return d.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
                    F.coalesce(F.size(F.filter("ids", lambda x: x.between(low, high))), F.lit(0))
                    .cast("long").alias("n_byte_pieces"),
                    F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                    F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"))
