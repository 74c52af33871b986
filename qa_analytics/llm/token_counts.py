"""Token counts of whole texts; huge ones in overlapping chunks that are spliced exactly.

A text up to one chunk is encoded whole. A longer one is encoded in chunks that
overlap; the ends of all pieces are kept as byte offsets. Two neighbouring
chunks are spliced at a place in the overlap where both have a piece end and
where the vocabulary proves that no piece can reach across: before a space mark
that follows another character, given that no piece holds a space mark after
another character. Merges on the two sides of such a place never meet, so the
pieces are those of the whole text. Without such a place the overlap is
doubled, at last to the whole chunk, which then just grows.

The model is a SentencePiece file; its path is a parameter, and its bytes (about
0.5 MB) travel with the task. If a vocabulary does not give the proof, or
normalises text, texts are encoded whole.

Null text counts as empty (no bytes, no tokens). Every row is counted by
itself, so repeated rows and ids do not matter; other columns pass through. No
shuffle; a task holds one small batch of texts at a time.
"""

import re

import numpy as np
import pyarrow as pa
import sentencepiece

from pyspark.sql import DataFrame, functions as F, types as T

from .common import own

MARK = "▁"
CHUNK, OVERLAP = 1 << 16, 1 << 10
GROUP = 32


class Counter:
    """Counts the tokens of texts with one model."""

    def __init__(self, model: bytes, chunk=CHUNK, overlap=OVERLAP):
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chunk, self.overlap = chunk, overlap
        n = self.encoder.get_piece_size()
        pieces = [self.encoder.id_to_piece(i) for i in range(n)]
        self.width = np.array([1 if self.encoder.is_byte(i) else len(p.encode()) for i, p in enumerate(pieces)])
        self.proven = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) and self._plain()

    def _plain(self):
        """True if spaces only turn into marks and one mark is put in front."""
        tried = " a  b\t\néﬁ ① A "
        return self.encoder.normalize(tried) == MARK + tried.replace(" ", MARK)

    def ends(self, norm, start, stop):
        """Byte offsets in `norm` at which the pieces of a chunk end; the first counts the mark put in front."""
        ids = self.encoder.encode(norm[start:stop].decode(), num_threads=1)
        return start - len(MARK.encode()) + np.cumsum(self.width[ids])

    def count(self, text):
        if len(text) <= self.chunk or not self.proven:
            return len(self.encoder.encode(text, num_threads=1))
        norm = text.replace(" ", MARK).encode()
        mark, size = MARK.encode(), len(norm)

        def whole(at):
            """`at`, moved back to the start of a character."""
            while 0 < at < size and norm[at] & 0xC0 == 0x80:
                at -= 1
            return at

        start, stop, counted, total = 0, whole(min(self.chunk, size)), -1, 0
        ends = self.ends(norm, start, stop)
        while stop < size:
            overlap = self.overlap
            while True:
                after = whole(max(start, stop - overlap))
                reach = whole(min(size, after + max(self.chunk, 2 * overlap) + overlap))
                onward = self.ends(norm, after, reach)
                if after == start:
                    # The chunk has no place to splice: it grows instead.
                    break
                both = np.intersect1d(ends, onward, assume_unique=True)
                stable = [p for p in both[(both > after) & (both < stop)].tolist()
                          if norm[p:p + 3] == mark and norm[p - 3:p] != mark]
                if stable:
                    at = stable[len(stable) // 2]
                    total += int(((ends > counted) & (ends <= at)).sum())
                    counted = at
                    break
                overlap *= 2
            start, stop, ends = after, reach, onward
        return total + int((ends > counted).sum())

    def counts(self, texts):
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        out = [0] * len(texts)
        for i, ids in zip(short, self.encoder.encode([texts[i] for i in short], num_threads=1)):
            out[i] = len(ids)
        for i in set(range(len(texts))) - set(short):
            out[i] = self.count(texts[i])
        return out


def count_tokens(docs: DataFrame, model_path, text="text", limit=4096, chunk=CHUNK, overlap=OVERLAP) -> DataFrame:
    """`docs` without its text, with a struct column `tokens` (n_bytes, n_tokens, over_limit); see the module's text."""
    with open(model_path, "rb") as file:
        model = file.read()
    name = own("tokens", docs)
    others = [c for c in docs.columns if c != text]
    kind = T.StructType([*(docs.schema[c] for c in others), T.StructField("n_bytes", T.LongType()),
                         T.StructField("n_tokens", T.LongType())])

    def run(batches):
        counter = Counter(model, chunk, overlap)
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([len(t.encode()) for t in texts], pa.int64()),
                     pa.array(counter.counts(texts), pa.int64())],
                    names=kind.names)

    # Counts get their own names at the end, so that columns of `docs` with such names stay.
    kind = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kind.fields)])
    counted = docs.select(*(F.col(f"`{c}`") for c in others), F.col(f"`{text}`")).toDF(
        *(f"c{i}" for i in range(len(others))), "t").mapInArrow(run, kind)
    n_bytes, n_tokens = F.col(f"c{len(others)}"), F.col(f"c{len(others) + 1}")
    return counted.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(others)),
        F.struct(n_bytes.alias("n_bytes"), n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit")).alias(name))
