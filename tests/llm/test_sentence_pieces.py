import math

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from quire.llm import sentence_pieces as s
from tests.llm.common import documents, messy_rows

TEXTS = [
    "", " ", "  a", "x   y", "tail  ", "z" * 500, "漢字かな" * 60, "emoji 😀😀 \t\n tab", "\x00\x01 bin", " " * 70 + "q",
    "▁sign ▁▁ x", "a\nb\n\nc", "mixed ÄÖÜ ñandú été", "</s> <s> <unk> <0x41>", "The quick brown fox jumps." * 9,
]


def test_equals_the_library(spark):
    rows = messy_rows() + [(500 + k, t, "t") for k, t in enumerate(TEXTS)]
    lib = sentencepiece.SentencePieceProcessor(model_file=s.MODEL)
    got = s.encode(documents(spark, rows, clash=True)).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t, _ in rows:
        if i is not None:
            assert list(by_id[i].token_ids) == lib.encode(t or ""), repr(t)[:60]
            assert by_id[i].n_tokens == len(by_id[i].token_ids)


def test_decode_gives_the_texts_back(spark):
    rows = [(k, t, "t") for k, t in enumerate(TEXTS)]
    out = {r.doc_id: r.text for r in s.decode(s.encode(documents(spark, rows))).collect()}
    assert out == {k: t.replace("▁", " ") for k, t, _ in rows}


def test_empty_table(spark):
    assert s.encode(documents(spark, [])).collect() == []


def unigram_model():
    model = proto.ModelProto()
    with open(s.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for i, piece in enumerate(model.pieces):
        if piece.type == 1:
            piece.score = -math.log(i + 7.3) - 0.37 * math.sin(i)
    return model


@pytest.mark.parametrize("text", [t for t in TEXTS if 0 < len(t) < 80])
def test_viterbi_finds_the_best_path(text):
    import pyarrow as pa

    from quire.llm import textkit as tk

    p = s.Pieces.of(unigram_model())
    encoder, decoder = s.Encoder(p), s.Decoder(p)
    _, _, buf, starts = next(tk.chunks(pa.array([text])))
    ids, first = encoder.encode(buf, starts)
    raw, at = decoder.decode(ids, first)
    clean = text.replace("▁", " ")
    assert raw.tobytes().decode() == clean
    # plain dynamic programming over the whole text
    t = " " + clean
    worst = float(p.scores[p.kinds == 1].min() - 10)
    best = [0.0] + [-math.inf] * len(t)
    for e in range(1, len(t) + 1):
        for b in range(max(0, e - p.longest), e):
            k = p.by_bytes.get(t[b:e].encode())
            score = float(p.scores[k]) if k is not None else (worst if e == b + 1 else -math.inf)
            best[e] = max(best[e], best[b] + score)
    mine, spelled = 0.0, b""
    for i in ids.tolist():
        if p.kinds[i] == 6:
            spelled += p.surface[i]
            try:
                mine += worst * len(spelled.decode())
                spelled = b""
            except UnicodeDecodeError:
                pass
        else:
            mine += float(p.scores[i])
    assert mine == pytest.approx(best[-1], rel=1e-6)
