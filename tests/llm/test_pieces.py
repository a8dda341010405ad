import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece

from support import prose
from venuerank.llm import pieces
from venuerank.llm.text import slices

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  a  b ", "a\n\n\tb\r\n", "x▁y ▁ ▁▁z", "\0▁\0", "<s> </s> <0x0A> <unk>", "😀 é ǘ 中文", "a" * 500, " " * 300, "word" * 5000]


def rows():
    return [*enumerate(ODD), *((100 + i, prose(i, i)) for i in range(60)), (900, prose(30_000, 1)), (101, prose(1, 1)), (None, "no id")]


def test_texts_come_back(documents):
    held = rows()
    got = pieces.encoded(documents(held, clash=True), PATH)
    assert got.filter("NOT lossless").count() == 0 and got.count() == len(held)
    assert all(r.n_pieces == len(r.ids) for r in got.collect())
    back = sorted((str(r.doc_id), r.text) for r in pieces.decoded(got, PATH).collect())
    assert back == sorted((str(i), t or "") for i, t in held)


def test_without_dropout_ids_are_the_models(documents):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    held = [(i, t) for i, t in rows() if i is not None and "▁" not in (t or "")]
    got = sorted((r.doc_id, r.ids) for r in pieces.encoded(documents(held), PATH, dropout=0.0).collect())
    assert got == sorted((i, model.encode(t or "")) for i, t in held)


def test_dropout_is_keyed_and_varied(documents):
    text = "segmentation of international communication " * 40
    df = documents([(1, text), (2, text), (1, text)])
    first = sorted((r.doc_id, r.ids) for r in pieces.encoded(df, PATH).collect())
    again = sorted((r.doc_id, r.ids) for r in pieces.encoded(df.repartition(3), PATH).collect())
    other = sorted((r.doc_id, r.ids) for r in pieces.encoded(df, PATH, seed=21).collect())
    assert first == again and first != other
    assert first[0] == first[1] and first[0][1] != first[2][1]  # by document, not by row
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert len(first[0][1]) > len(model.encode(text))
    whole = sorted(r.n_pieces for r in pieces.encoded(df, PATH, dropout=1.0).collect())
    assert whole[0] == len(text) + 1  # nothing merges: each character and the model's own blank


def test_empty_table(documents):
    assert pieces.encoded(documents([]), PATH).count() == 0
    assert pieces.decoded(pieces.encoded(documents([]), PATH), PATH).count() == 0


def symbols_of(vocabulary, word):
    return vocabulary.symbols(np.frombuffer(word.replace("▁", " ").encode(), np.uint8))[1].tolist()


def plain(vocabulary, symbols, key, dropout):
    """One word's agenda by its definition."""
    from venuerank.llm.text import mix

    symbols, skipped = list(enumerate(symbols)), set()
    while True:
        found = []
        for (a, left), (_, right) in zip(symbols, symbols[1:]):
            piece = int(vocabulary.merge(np.array([left]), np.array([right]))[0])
            if piece >= 0 and (a, left, right) not in skipped:
                found.append((-vocabulary.score[piece], a, piece, left, right))
        if not found:
            return [s for _, s in symbols]
        _, a, piece, left, right = min(found)
        drawn = mix(np.array([key]) ^ mix(np.array([(a << 32) | piece], np.uint64)))[0]
        if drawn < int(dropout * 2**64):
            skipped.add((a, left, right))
            continue
        k = [x for x, _ in symbols].index(a)
        symbols[k : k + 2] = [(a, piece)]


def test_lock_step_agendas_equal_single_ones():
    vocabulary = pieces.loaded(PATH)
    words = ["▁" + w for w in prose(40, 3).split()] + ["▁international", "aaaa", "▁▁▁x"]
    keys = np.arange(1, len(words) + 1, dtype=np.uint64)
    block = np.full((len(words), 20), -1, np.int32)
    for i, w in enumerate(words):
        block[i, : len(w)] = symbols_of(vocabulary, w)
    for dropout in (0.0, 0.3):
        got = pieces.run_agendas(vocabulary, block, keys, dropout)
        for i, w in enumerate(words):
            assert [x for x in got[i].tolist() if x >= 0] == plain(vocabulary, symbols_of(vocabulary, w), keys[i], dropout)


def test_slices_of_bytes():
    vocabulary = pieces.loaded(PATH)
    for part in slices(pa.array(ODD), 10):
        ids, bounds = pieces.encode_slice(vocabulary, part, np.zeros(len(part.bounds) - 1, np.uint64))
        data, back = pieces.decode_slice(vocabulary, ids, bounds)
        assert data.tobytes() == part.data.tobytes() and back.tolist() == part.bounds.tolist()


def test_every_occurrence_is_drawn_by_document_and_place():
    vocabulary = pieces.loaded(PATH)
    word, texts = " international", ["x" + " international" * 500, "x" + " international" * 500, prose(40, 3)]
    part, keys = next(slices(pa.array(texts))), pieces.mix(np.array([7, 8, 9], np.uint64))
    ids, bounds = pieces.encode_slice(vocabulary, part, keys)
    whole = pieces.encode_slice(vocabulary, part, keys, 0.0)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert whole[0][: whole[1][1]].tolist() == model.encode(texts[0])
    seen = set()
    for i, text in enumerate(texts):
        # every word's agenda by its definition, under its own key
        want = []
        starts = [k for k, c in enumerate(text) if k == 0 or c == " "] + [len(text)]
        for place, (a, b) in enumerate(zip(starts, starts[1:])):
            key = pieces.mix(keys[i : i + 1] ^ pieces.mix(np.array([place + pieces.SEED * 1000003], np.uint64)))[0]
            symbols = ([vocabulary.blank] if place == 0 else []) + symbols_of(vocabulary, text[a:b])
            got = plain(vocabulary, symbols, key, pieces.DROPOUT)
            want += got
            if text[a:b] == word:
                seen.add(tuple(got))
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want
    assert len(seen) > 16  # more than eight variants, and eight of a text's first word, could give
