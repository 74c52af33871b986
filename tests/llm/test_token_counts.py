import random

import public_tokenizers
import pytest
import sentencepiece
from helpers import docs

from qa_analytics.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "one", "a  b\n\tc", "<s> x </s> <unk>", "x" * 3000, " " * 3000, "ab▁c ▁d " * 300, "é́ 😀 <0x0A>" * 200,
    "日本語テキスト" * 300, "\n" * 2000, "the cat sat " * 400, "  lead" * 500, "tail  " * 500,
]


@pytest.fixture(scope="module")
def encoder():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_spliced_counts_equal_whole_texts(encoder):
    with open(MODEL, "rb") as file:
        counter = token_counts.Counter(file.read(), chunk=200, overlap=8)
    assert counter.proven
    rng = random.Random(9)
    for text in [*filter(None, TEXTS), *("".join(rng.choice("ab é▁\n.0") for _ in range(3000)) for _ in range(20))]:
        assert counter.count(text) == len(encoder.encode(text)), text[:40]


def test_counts_of_a_table(spark, encoder):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, "again"), (None, "no id")]
    frame = docs(spark, rows, tokens="mine", c0="x")
    out = token_counts.count_tokens(frame, MODEL, limit=50, chunk=500)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "tokens", "c0", "_tokens"]
    got = sorted((str(r.doc_id), *r["_tokens"]) for r in out.collect())
    want = [(str(i), len((t or "").encode()), n := len(encoder.encode(t or "")), n > 50) for i, t in rows]
    assert got == sorted(want)
    assert token_counts.count_tokens(frame.limit(0), MODEL).count() == 0
