"""SentencePiece encoding against the library: random texts, odd rows and the small documents."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from floorlens.llm import piece_bpe

PATH = public_tokenizers.path(piece_bpe.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(text):
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    return ids, LIBRARY.decode(ids)


def coded(docs):
    got = piece_bpe.decode(piece_bpe.encode(docs, PATH), PATH).collect()
    return [(r.doc_id, [int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)], r.decoded) for r in got]


def test_random_texts_equal_the_library():
    rng, table = random.Random(4), piece_bpe.Pieces(PATH)
    letters = " " * 6 + "▁abcdeéß中😀\n\t\x00.,the ing<>0x41s/　"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(5000)]
    bounds, ids = table.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == expected(text)[0], repr(text)


def test_marks_join_leftmost_first():
    table = piece_bpe.Pieces(PATH)
    for n in range(1, 70):
        assert table.merge(piece_bpe.MARK * (n + 1)) == LIBRARY.encode(" " * n)


def test_documents_and_odd_rows(spark):
    odd = [(1, None), (2, ""), (3, " "), (4, "   "), (None, "▁a▁"), (5, "one two"), (5, "one two"), (6, "x" * 30_000),
           (7, "word " * 5000), (8, " a  b\n\n c "), (9, "<s> </s> <unk> <0x41>"), (10, "😀中\x00")]
    rows = spark.createDataFrame([(i, t, "c", 1) for i, t in odd], "doc_id long, text string, body string, ids int")
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for docs in (rows, documents):
        want = [(r.doc_id, *expected(r.text)) for r in docs.select("doc_id", "text").collect()]
        assert sorted(map(str, coded(docs))) == sorted(map(str, want))
    assert coded(rows.where(F.lit(False))) == []


def test_other_kinds_of_vocabulary_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto.FromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        piece_bpe.Pieces(str(tmp_path / "other.model"))
