"""Stages of the pipeline against plain versions, at the size of the fixture."""

import zlib

import numpy as np
import public_tokenizers
from test_operators import plain_classes
from tokenizers import Tokenizer

from pathloom.llm import ngram_join, packing


def test_near_copies_of_the_fixture(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    classes = plain_classes([t for _, t in texts])
    expected = {i for k, (i, _) in enumerate(texts) if classes[k][1] == k}
    assert len(texts) >= 200 and len(expected) < len(texts)
    assert {r.doc_id for r in ngram_join.drop_near_copies(docs).collect()} == expected


def test_packing_of_the_fixture(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        for piece, (a, b) in enumerate(zip([0, *range(first, len(ids), 1024)], range(first, len(ids) + 1, 1024), strict=True)):
            expected[r.doc_id, piece] = (a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))
    rows = packing.pack(docs).collect()
    assert len(rows) == len(expected) and {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 1024 and set(sequences) == set(range(len(sequences)))
