import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from support import prose
from venuerank.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, got, capacity):
    encoder = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = encoder.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want.append((str(i), k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r.length for r in got) // capacity)


def test_pieces_and_sequences(documents):
    rows = [(i, prose(i % 70, i)) for i in range(300)]
    rows += [(500, None), (501, ""), (502, "A\tB’s  é <|endoftext|> ½ x 12"), (503, prose(9000, 1)), (503, prose(9000, 1)), (None, "x")]
    used, least = check(rows, packing.packed(documents(rows, clash=True), PATH).collect(), 4096)
    assert used <= least + 2
    used, least = check(rows, packing.packed(documents(rows), PATH, 64).collect(), 64)
    assert used <= 1.1 * least


def test_items_that_fit_together_nowhere_end_the_tree(spark, monkeypatch):
    monkeypatch.setattr(packing, "BINS_PER_TASK", 40)
    rows = [(i, 0, 0, 60, i) for i in range(500)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(6)
    got = packing.pack(pieces, 100).collect()
    assert len(got) == 500 and len({r.sequence_id for r in got}) == 500


def test_residues_meet_up_the_tree(spark):
    rows = [(i, 0, 0, 50 if i % 2 else 40 + i % 11, i) for i in range(60)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(30)
    got = packing.pack(pieces, 100).collect()
    assert len({r.sequence_id for r in got}) <= 31


@pytest.mark.parametrize("per_task", [50_000, 2_000])
def test_many_partitions_are_close_to_one_task(spark, monkeypatch, per_task):
    """64 partitions of documents against best fit over all of them at once."""
    monkeypatch.setattr(packing, "PIECES_PER_TASK", per_task)
    draw = np.random.default_rng(4)
    lengths = np.minimum(4096, (draw.lognormal(6.5, 1.2, 20_000) + 1).astype(int))
    rows = [(i, 0, 0, int(n), i) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(64)
    got = packing.pack(pieces).select("doc_id", "sequence_id").collect()
    alone = packing.best_fit(lengths, 4096)[0].max() + 1
    assert len(got) == 20_000 and len({r.sequence_id for r in got}) <= 1.005 * alone


def test_empty_table(documents):
    assert packing.packed(documents([]), PATH).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_best_fit(seed):
    lengths = np.random.default_rng(seed).integers(1, 100, 400)
    bins, offsets = packing.best_fit(lengths, 100)
    room = np.zeros(bins.max() + 1, int)
    for i in np.argsort(-lengths, kind="stable"):
        open_ = [r for r in room if r and 100 - r >= lengths[i]]
        assert offsets[i] == (max(open_) if open_ else 0) == room[bins[i]]
        room[bins[i]] += lengths[i]
