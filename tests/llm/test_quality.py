import zlib

import numpy as np
import pyarrow as pa
import pytest

from support import prose
from venuerank.llm import quality
from venuerank.llm.text import slices


def corpus(n=320):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        text = prose(60 + i % 40, i)
        if not good:
            w = text.split()
            text = "%%% ".join(w) if i % 2 else " ".join(x for x in w[:8] for _ in range(9))
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(spark, documents):
    rows, labels = corpus()
    odd = [(1000, None), (1001, ""), (1002, "a"), (1003, prose(20_000, 5)), (1004, rows[1][1]), (None, rows[1][1])]
    got = quality.score_documents(documents(rows + odd, clash=True), table(spark, labels + [(1000, None, 0)])).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + len(odd)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [i for i, _ in rows if by_id[i].held_out]
    assert len(held) > 50 and np.mean([by_id[i].predicted == int(i % 3 != 0) for i in held]) > 0.9
    assert by_id[1000].score == by_id[1001].score
    assert by_id[1004].score == pytest.approx(by_id[1].score, abs=1e-6)


@pytest.mark.parametrize("labels, want", [([], 0.5), ([(i, 1, 0) for i in range(20)], 1.0), ([(i, 0, 0) for i in range(20)], 0.0)])
def test_one_class_or_none(spark, documents, labels, want):
    got = quality.score_documents(documents([(i, prose(9, i)) for i in range(20)]), table(spark, labels)).collect()
    assert all(r.score == pytest.approx(want, abs=1e-5) for r in got)


def test_empty_tables(spark, documents):
    assert quality.score_documents(documents([]), table(spark, [])).count() == 0


def plain(net, text):
    """The network's value by its definition, one chunk after another."""
    data = (text or "").encode()
    half = quality.CHUNK // 2
    data = data + bytes(max(2, -(-len(data) // half)) * half - len(data))
    tops = []
    for a in range(0, len(data) - half, half):
        chunk = data[a : a + 2 * half]
        got = []
        for i in range(0, 2 * half, quality.STRIDE):
            window = (data[a + i : a + i + quality.WIDTH] + bytes(quality.WIDTH))[: quality.WIDTH]
            got.append(net.embed[list(window)].ravel() @ net.filters)
        best = np.maximum(np.max(got, 0) + net.shift, 0)
        tops.append(np.concatenate([np.maximum(best @ net.units + net.lift, 0), best]))
        assert len(chunk) == 2 * half
    return 1 / (1 + np.exp(-(np.max(tops, 0) @ net.out + net.bias[0])))


def test_scores_follow_the_definition():
    net = quality.fresh()._replace(shift=np.linspace(-1, 1, quality.FILTERS).astype(np.float32))
    texts = [None, "", "short", prose(40, 1), prose(300, 2), "é" * 700]
    for text in texts:  # one text alone, so that what follows it can't matter
        assert quality.predict(net, next(slices(pa.array([text], pa.string()))))[0] == pytest.approx(plain(net, text), abs=1e-4)


def test_gradients_follow_differences():
    net = quality.fresh()
    part, y, weight = next(slices(pa.array([prose(60, 1), prose(90, 2), "zz"]))), np.array([1, 0, 1], np.float32), np.array([1, 2, 1], np.float32)
    found = quality._gradients(net, part, y, weight)

    def loss(some):
        p = np.clip(quality.predict(some, part), 1e-6, 1 - 1e-6)
        return float((-(y * np.log(p) + (1 - y) * np.log(1 - p)) * weight).mean())

    for name, at in (("out", (3,)), ("out", (20,)), ("bias", (0,)), ("lift", (2,)), ("units", (5, 2)), ("filters", (9, 5)), ("embed", (97, 1)), ("shift", (5,))):
        moved = []
        for step in (1e-2, -1e-2):
            w = getattr(net, name).copy()
            w[at] += step
            moved.append(loss(net._replace(**{name: w})))
        assert getattr(found, name)[at] == pytest.approx((moved[0] - moved[1]) / 2e-2, abs=3e-3)


def test_overlapping_slices_of_texts_agree():
    net = quality.fresh()
    texts = [prose(50 * i, i) for i in range(1, 9)]
    whole = quality.predict(net, next(slices(pa.array(texts))))
    alone = [quality.predict(net, next(slices(pa.array([t]))))[0] for t in texts]
    assert whole == pytest.approx(alone, abs=2e-3)


def test_a_long_text_does_not_end_the_sample(spark, documents):
    rows, labels = corpus(120)
    # texts over the bound alone, some of them early in any order, and copies that stand together by their text's hash
    rows += [(500 + i, f"{i} " * 15_000) for i in range(60)] + [(600 + i, rows[2][1]) for i in range(30)]
    labels += [(500 + i, 0, 0) for i in range(60)] + [(600 + i, 1, 0) for i in range(30)]
    docs = documents(rows)
    net = quality.learn(docs, table(spark, labels), quality.fold(1) == 0, most_bytes=29_999)
    part = next(slices(pa.array([t for _, t in rows[:120]])))
    assert np.mean((quality.predict(net, part) >= 0.5) == [i % 3 != 0 for i in range(120)]) > 0.8


def test_a_class_without_a_text_that_fits_fails(spark, documents):
    docs = documents([(i, "x" * 30_000 if i < 5 else prose(9, i)) for i in range(20)])
    with pytest.raises(ValueError):
        quality.learn(docs, table(spark, [(i, int(i < 5), 0) for i in range(20)]), quality.fold(1) == 0, most_bytes=29_999)


def test_rows_that_fit_are_taken_in_order():
    assert quality.within([50, 3, 90, 4, 2], [1, 0, 1, 1, 0], 60) == [0, 1, 3, 4]
    assert quality.within([200, 3, 4], [1, 0, 1], 10) == [1, 2]
    assert sorted(quality.within([9, 8], [1, 0], 17)) == [0, 1]
    assert sorted(quality.within([9, 9, 3, 5], [1, 1, 1, 0], 10)) == [2, 3]


def test_scores_do_not_depend_on_the_next_text():
    net = quality.fresh()
    # one filter answers to a Q at a window's end
    embed, filters, out = np.zeros_like(net.embed), np.zeros_like(net.filters), np.zeros_like(net.out)
    embed[ord("Q"), 0] = filters[(quality.WIDTH - 1) * quality.EMBED, 0] = out[quality.HIDDEN] = 1
    some = net._replace(embed=embed, filters=filters, out=out)
    texts = ["", "z" * 256, "Q" * 384, prose(300, 2)[:1024], None, "QQQQQQ", prose(80, 4), "", "Q" * 512]
    for each in (net, some):
        alone = [quality.predict(each, next(slices(pa.array([t], pa.string()))))[0] for t in texts]
        for turn in range(len(texts)):
            moved = texts[turn:] + texts[:turn]
            got = quality.predict(each, next(slices(pa.array(moved, pa.string()))))
            assert got == pytest.approx(alone[turn:] + alone[:turn], abs=1e-6)
            assert got == pytest.approx([plain(each, t) for t in moved], abs=1e-4)
