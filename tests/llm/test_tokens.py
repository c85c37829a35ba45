"""Token files, the range coder and packing: exact round trips."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallyhouse.llm import packing, token_files
from tallyhouse.llm.rangecoder import decode_block, encode_block
from tallyhouse.llm.tokenizing import Encoder

P = pytest.importorskip("public_tokenizers")
NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def plain(name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(P.path(name)))
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


@pytest.mark.parametrize("name", NAMES)
def test_pieces_give_the_ids_of_the_whole_text(name, rows):
    encode, ours = plain(name), Encoder(str(P.path(name)), room=50)
    rng = random.Random(2)
    odd = [*"ab AB'.,!|\n\t 1é´ß\x00\x1c ñ漢", "<|endoftext|>", "  ", " 's", "İ", "Σ ", "́", " ", "\xa0"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 16))) for _ in range(3000)] + [t or "" for _, t in rows]
    for text in texts:
        assert ours.document(text) == encode(text).tobytes(), text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 199), max_size=400), st.integers(1, 9))
def test_coder_round_trip(ids, lanes):
    assert decode_block(encode_block(np.array(ids, dtype=np.int64), 200, lanes)).tolist() == ids


def test_coder_on_large_and_repeated_blocks():
    rng = np.random.default_rng(0)
    for ids in (rng.integers(0, 49_408, 70_000), np.full(50_000, 49_407), np.tile(rng.integers(0, 900, 700), 60)):
        block = encode_block(ids, 49_408)
        assert (decode_block(block) == ids).all()
    assert len(block) * 8 < 6 * len(ids)  # a repeated run is learned


def test_pairs_of_a_large_block_keep_their_guesses():
    """Each pair of 300,000 has one follower, which comes back often; the ids alone say little."""
    rng = np.random.default_rng(3)
    runs = rng.integers(0, 40_000, (30_000, 12))
    ids = runs[rng.integers(0, len(runs), 100_000)].ravel()
    block = encode_block(ids, 40_000)
    assert (decode_block(block) == ids).all()
    assert len(block) * 8 < 10.6 * len(ids)  # 12.7 without a check and with half the places


def test_rare_ids_cost_little_more_than_their_share():
    ids = np.random.default_rng(4).integers(0, 500, 1 << 20)
    assert len(encode_block(ids, 49_408)) * 8 < 9.45 * len(ids)  # log2(500) = 8.97


def test_damaged_blocks_are_refused():
    block = encode_block(np.arange(2000) % 300, 300)
    for bad in (block[:-2], block[:3], b"XXXX" + block[4:], block[:200] + bytes([block[200] ^ 1]) + block[201:]):
        with pytest.raises(ValueError):
            decode_block(bad)


def expected_files(rows, name):
    encode, out, start = plain(name), {}, 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = encode(text)
        out.setdefault(doc, []).append((start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def read_back(spark, docs, path, **options):
    token_files.write_ids(docs, path, str(P.path(NAMES[0])), **options)
    out = {}
    for r in token_files.read_ids(spark, path).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens
        out.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    return {k: sorted(v) for k, v in out.items()}


def test_files_round_trip(spark, docs, rows, tmp_path):
    assert read_back(spark, docs, str(tmp_path / "a"), block=5000) == expected_files(rows, NAMES[0])


def test_files_of_repeated_and_empty_tables(spark, twice, none, tmp_path):
    rows = [tuple(r) for r in twice.collect()]
    assert read_back(spark, twice, str(tmp_path / "t")) == expected_files(rows, NAMES[0])
    assert read_back(spark, none, str(tmp_path / "n")) == {}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 6000), max_size=30))
def test_windows_hold_every_id_once(sizes):
    windows = packing.pack(sizes)
    seen = [[] for _ in sizes]
    for size, pieces in windows:
        assert sum(length for _, _, length in pieces) <= size <= 2048
        for k, start, length in pieces:
            seen[k].append((start, length))
    for size, pieces in zip(sizes, seen):
        at = 0
        for start, length in sorted(pieces):
            assert start == at and length > 0
            at += length
        assert at == size
    short = [w for w, pieces in windows if sum(x[2] for x in pieces) < w]
    assert len(short) <= 1  # only what is left at the end is padded


def test_groups_have_like_cost():
    rng = random.Random(0)
    costs = [rng.choice([64, 512, 2048]) for _ in range(400)]
    groups = packing.step_groups(costs, 8)
    load = [sum(c for c, g in zip(costs, groups) if g == k) for k in range(8)]
    assert max(load) - min(load) <= 2048


def check_packed(frame, rows):
    encode = plain(NAMES[1])
    got = sorted(frame.collect(), key=lambda r: (r.sequence_id, r.offset))
    at = {}
    for r in got:
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert all(n <= 2048 for n in at.values())
    per = {}
    for r in got:
        per.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for doc, text in rows:
        ids, pieces, where = encode(text), sorted(per[doc]), 0
        for start, length, crc, total in pieces:
            assert (start, total) == (where, len(ids)) and zlib.crc32(ids[start : start + length].tobytes()) == crc
            where += length
        assert where == len(ids)
    assert set(per) == {doc for doc, _ in rows}


def test_packing(spark, docs, rows, none):
    check_packed(packing.packed(docs, str(P.path(NAMES[1])), chunk=30_000), rows)
    assert packing.packed(none, str(P.path(NAMES[1]))).count() == 0


def test_packing_repeated_rows(spark, twice):
    once = packing.packed(twice, str(P.path(NAMES[1])))
    ids = sum(len(plain(NAMES[1])(r.text)) for r in twice.collect())
    assert sum(r.length for r in once.collect()) == ids


@pytest.mark.parametrize("name", NAMES)
def test_plain_words_go_to_the_model_alone(name):
    """Words of plain letters need no normalizing and cutting, and have the ids of the whole tokenizer."""
    encode, ours = plain(name), Encoder(str(P.path(name)))
    rng = random.Random(6)
    letters = [chr(c) for c in (*range(97, 123), *range(0xDF, 0x100)) if c != 0xF7]
    words = ["".join(rng.choices(letters, k=rng.choice((1, 2, 5, 9, 40, 600)))) for _ in range(500)]
    calls, whole = [], ours.pieces.encode_piece
    ours.pieces.encode_piece = lambda piece, **more: calls.append(piece) or whole(piece, **more)
    for text in [*words, " ".join(words)]:
        assert ours.document(text) == encode(text).tobytes(), text
    assert not calls
    for text in ("ªº µ", "ŉ ǰ ı", "don't l'été", "x²½", "Straße ÀÉ"):
        assert ours.document(text) == encode(text).tobytes(), text


@pytest.mark.parametrize("total", [1, 7, 70_000, 3_000_000])
def test_places_of_the_order_0_table_have_their_holder(total):
    """The kept first holders give what a search of the whole table gives, at every bound and beside it, also after a rebuild."""
    from tallyhouse.llm.rangecoder import _Model

    rng = np.random.default_rng(total)
    model = _Model(total if total < 10 else 500, 1)
    for _ in range(2):
        if total >= 10:
            model.frequency = 1 + rng.multinomial(total, rng.dirichlet(np.full(500, 0.05)))
        model.rebuild()
        place = np.unique(np.clip(np.concatenate([model.bounds + d for d in (-1, 0, 1)] + [rng.integers(0, model.total, 500)]), 0, model.total - 1))
        assert (model.holders(place) == np.searchsorted(model.bounds, place, "right") - 1).all()


def test_a_worker_keeps_no_more_pieces_than_it_has_room_for():
    """Words and words with marks, one in six of the latter beside: what does not fit is encoded each time."""
    encode, ours = plain(NAMES[1]), Encoder(str(P.path(NAMES[1])), room=60)
    text = " ".join(f"{a}{b}{c}{end}" for a in "abcde" for b in "xyz" for c in "aeiou" for end in ("", ",", "?!"))
    assert ours.document(text) == encode(text).tobytes()
    assert 60 <= len(ours.pieces) <= 70


def test_other_work_lets_go_of_the_encoder():
    """Encoders with their pieces are kept from task to task of a packing, and go when the worker gets other work."""
    import pyarrow as pa

    from tallyhouse.llm import common, tokenizing

    batch = pa.record_batch({"text": ["some text", None, "more"]})
    tokenizing.encoder.cache_clear()
    kept = tokenizing.encoder(str(P.path(NAMES[1])), 100)
    common.lean_worker(encoders=True)
    assert tokenizing.encoder(str(P.path(NAMES[1])), 100) is kept
    assert [len(s) for s in common.units([batch])] == [3]
    assert tokenizing.encoder.cache_info().currsize == 0


def test_blocks_keep_their_bytes_and_places_need_no_cast():
    """Blocks written before can be read: the bytes are those of the first coder of this format. Ids serve as places in tables as they are."""
    from tallyhouse.llm.rangecoder import _Model

    ids = np.random.default_rng(12).zipf(1.3, 60_000) % 700
    assert zlib.crc32(encode_block(ids, 700)) == 658045451
    model = _Model(700, 4)
    model.predict()
    assert {a.dtype for a in (model.last, model.before, *model.slots, model.cell)} == {np.dtype(np.intp)}


@pytest.mark.parametrize("name", NAMES)
def test_documents_of_a_batch_have_the_ids_of_the_whole_texts(name, rows):
    """Many texts at once, among them odd ones, empty ones and some that go to the tokenizer whole."""
    encode, ours = plain(name), Encoder(str(P.path(name)), room=50)
    rng = random.Random(8)
    odd = [*"ab AB'.,!|\n\t 1é´ß÷×«\x00\x1c ñ漢Σ", "<|endoftext|>", "  ", "İ", "́", "H̱", "≮", "\xa0", "É,", "漢."]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 16))) for _ in range(1500)] + [t or "" for _, t in rows]
    for some in (texts, texts[-1:], ["", ""], ["<|endoftext|>"], []):
        ids, sizes = ours.documents(some)
        expected = [encode(text) for text in some]
        assert sizes.tolist() == [len(e) for e in expected]
        assert ids.tobytes() == b"".join(e.tobytes() for e in expected)


def test_words_of_a_batch_are_looked_up_once():
    """A word that repeats, with or without a mark after it, is one look-up for all texts of a batch."""
    ours, calls = Encoder(str(P.path(NAMES[0]))), []
    pieces, texts = ours.pieces, ["One étape, one word; one ÉTAPE.", "word one!\nétape word?", "été« one"]
    expected = b"".join(ours.document(text) for text in texts)

    class Counted:
        def __getitem__(self, piece):
            calls.append(piece)
            return pieces[piece]

    ours.pieces = Counted()
    assert ours.documents(texts)[0].tobytes() == expected
    assert sorted(calls) == sorted({"one", "étape", "word", "été«", ",", ";", ".", "!", "?"})


def test_blocks_end_with_the_document_that_fills_them(spark, docs, tmp_path):
    path = str(tmp_path / "b")
    token_files.write_ids(docs, path, str(P.path(NAMES[0])), block=2000)
    parts = {}
    for r in spark.read.parquet(path).orderBy("part", "block").collect():
        assert r.n_ids == sum(r.sizes) and len(r.sizes) == len(r.doc_ids) and r.n_ids - r.sizes[-1] < 2000
        parts.setdefault(r.part, []).append(r)
    for blocks in parts.values():
        assert [r.block for r in blocks] == list(range(len(blocks)))
        assert [r.before for r in blocks] == [sum(b.n_ids for b in blocks[:k]) for k in range(len(blocks))]
        assert all(r.n_ids >= 2000 for r in blocks[:-1])


def test_a_pair_and_its_check_share_a_place():
    """A step reads and writes one table for order 2; the bytes of a block in which pairs share slots stay those of two tables."""
    from tallyhouse.llm.rangecoder import _Model

    rng = np.random.default_rng(21)
    runs = rng.integers(0, 40_000, (60_000, 8))
    ids = runs[rng.zipf(1.2, 80_000) % len(runs)].ravel()
    block = encode_block(ids, 40_000)
    assert zlib.crc32(block) == 2243496510 and (decode_block(block) == ids).all()
    assert not any(isinstance(v, np.ndarray) and len(v) == 1 << 18 for v in vars(_Model(700, 4)).values())  # none beside the tables
