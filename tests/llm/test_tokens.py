from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents, sample, stored, texts
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stockloom.llm import bounded_packing as packing, grammar_store as store
from stockloom.llm.queries import LLM_QUERIES
from stockloom.llm.text_batches import LETTER, SPACE, Words, flat, sliced
from stockloom.llm.tokens import TextEncoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a  b", "a \n b", "\n\n x\t y  ", "foo.\nBar  ,baz", "it's  we'll", "<|endoftext|> a <|endoftext|>b", "日本 語，x", " é è", "\x1c a \x1c b", "a\x00 b\x00", "ab \x85 c \x85d", "a\u2003 b", "a,\nb.\n c. d,\n", "x. y\n"]


@pytest.fixture(scope="session")
def library():
    """The tokenizers library's own encoder."""
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab. ,\n\t\u00e9\u2003'1A\x00|<>", "  ", "<|endoftext|>"]), max_size=40).map("".join))
def test_encoder_equals_library(text):
    encoder = TextEncoder.of(VOCABULARY)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_on_odd_texts(library):
    encoder = TextEncoder(VOCABULARY, keep=3)
    for text in [*ODD, *ODD, *(r["text"] for r in sample()[:60])]:
        assert encoder.encode(text) == ids_of(library, text).tobytes(), text[:50]


def test_words_of_flat_texts():
    column = pa.array(["Ab c", None, "", "dé-f", " c"])[1:].slice(0, 4)
    data, offsets = flat(column)
    words = Words(data, offsets, ~SPACE)
    assert words.first.tolist() == [0, 0, 0, 1, 2]
    both = Words(*flat(pa.array(["x yy zzz", "zzz yy"])), LETTER).hashes()
    assert both[2] == both[3] and both[1] == both[4] and len(set(both.tolist())) == 3
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 50, "c"])], ["t"])
    assert [b.num_rows for b in sliced([batch], "t", 20)] == [2, 1, 1]


@pytest.mark.parametrize("seed", range(4))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.choice(6 if seed % 2 else 300, rng.integers(0, 4000), replace=True).astype("<u4") for _ in range(20)]
    docs[3] = np.zeros(3000, "<u4")  # overlapping occurrences of one pair
    body = store.pack_shard([None, *range(1, 20)], [d.tobytes() for d in docs], 300, least=8, pairs_per_round=50, rounds=6)
    shard = store.Shard(body)
    assert shard.doc_ids == [None, *range(1, 20)]
    for k, d in enumerate(docs):
        assert shard.document(k).tolist() == d.tolist()
        if len(d) > 10:
            assert shard.token_range(k, 5, len(d) - 3).tolist() == d[5:-3].tolist()
            assert shard.token_range(k, 3, 4).tolist() == d[3:4].tolist()
    assert "_table" not in vars(shard)  # no rule was expanded that was not asked for
    assert shard.expand(shard.symbols).tolist() == np.concatenate(docs).tolist()
    for left, right in shard.rules:
        assert max(left, right) < 300 + len(shard.rules)
    assert len(shard.symbols) < sum(map(len, docs))


def test_token_files(spark, tmp_path, library):
    store.write_token_files(documents(spark), f"{tmp_path}/a", VOCABULARY, shard_tokens=500)
    got = store.read_token_files(spark, f"{tmp_path}/a").orderBy("start").collect()
    rows = sorted(texts(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    expected = {}
    for doc, text in rows:
        ids = np.r_[ids_of(library, text), 2].astype("<u4")
        expected.setdefault(doc, []).append((len(ids), zlib.crc32(ids.tobytes())))
    at, found = 0, {}
    for r in got:
        assert r.start == at
        at += r.n_tokens
        found.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    store.write_token_files(documents(spark, []), f"{tmp_path}/b", VOCABULARY)
    assert store.read_token_files(spark, f"{tmp_path}/b").count() == 0


def check_packing(pieces, rows, library, size):
    ids = {}
    for doc, text in rows:
        ids.setdefault(doc, []).append(np.r_[ids_of(library, text), 0].astype("<u4"))
    windows = {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append(p)
    for own in windows.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size
    for doc, versions in ids.items():
        own = [p for p in pieces if p.doc_id == doc]
        assert sum(p.length for p in own) == sum(map(len, versions))
        if len(versions) == 1:
            at = 0
            for p in sorted(own, key=lambda p: p.start):
                assert (p.start, p.doc_tokens) == (at, len(versions[0]))
                assert p.ids_crc32 == zlib.crc32(versions[0][at : at + p.length].tobytes())
                at += p.length
    return len(windows)


def test_packing_of_awkward_rows(spark, library):
    for size, windows, fan_in in ((1024, 64, 64), (50, 2, 2)):
        pieces = packing.pack_documents(documents(spark), VOCABULARY, size=size, windows=windows, fan_in=fan_in, least_cut=8).collect()
        check_packing(pieces, texts(), library, size)
    assert packing.pack_documents(documents(spark, []), VOCABULARY).count() == 0


def test_packing_in_many_rounds(spark, library):
    rows = [(i, "word " * (1 + i * 37 % 90)) for i in range(300)]
    df = documents(spark, rows).repartition(12)
    pieces = packing.pack_documents(df, VOCABULARY, size=64, windows=3, fan_in=2, least_cut=8).collect()
    used = check_packing(pieces, rows, library, 64)
    assert sum(p.length for p in pieces) / (64 * used) > 0.95


def test_packing_query(spark, library):
    pieces = LLM_QUERIES["op8_packing"](spark, "/root/testdata/sf0.001").collect()
    used = check_packing(pieces, [(r["doc_id"], r["text"]) for r in sample()], library, 1024)
    assert sum(p.length for p in pieces) / (1024 * used) > 0.9


def test_file_query(spark, library, tmp_path):
    got = LLM_QUERIES["op3_token_files"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    at = 0
    for r, row in zip(got, sorted(sample(), key=lambda r: r["doc_id"]), strict=True):
        ids = np.r_[ids_of(library, row["text"]), 2].astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (row["doc_id"], at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    folder = stored(spark, tmp_path, documents=documents(spark, []))
    assert LLM_QUERIES["op3_token_files"](spark, folder).count() == 0


def pairs_of(symbols, first):
    """How often each pair of neighbours within a document occurs; of a run of equal ids every second pair counts."""
    found, taken = {}, {}
    for a, b in zip(first[:-1], first[1:], strict=True):
        for k in range(a, b - 1):
            pair = (int(symbols[k]), int(symbols[k + 1]))
            if taken.get(pair) != k - 1 or pair[0] != pair[1]:
                found[pair], taken[pair] = found.get(pair, 0) + 1, k
    return found


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(8)
    passage = rng.integers(0, 5000, 300).astype("<u4")
    docs = [np.r_[rng.integers(0, 5000, rng.integers(0, 60)).astype("<u4"), passage] for _ in range(400)]
    docs += [rng.zipf(1.5, 2000).clip(max=5000).astype("<u4") - 1 for _ in range(20)]
    starts = np.cumsum([0, *map(len, docs[:-1])])
    _, lengths, symbols, first = store.compress(np.concatenate(docs), starts, 5000)
    assert max(pairs_of(symbols, first).values()) < 64
    assert lengths.max() >= 256 and len(symbols) < 40_000
    shard = store.Shard(store.pack_shard(list(range(len(docs))), [d.tobytes() for d in docs], 5000))
    assert all(shard.document(k).tolist() == d.tolist() for k, d in enumerate(docs))


def test_a_rare_pair_does_not_keep_its_slot():
    """Two pairs of one place in the table of counts: the frequent one is taken, though the rare one comes last."""
    place = {}
    for often in np.random.default_rng(0).integers(0, 5000, (5000, 2)).tolist():
        slot = (((often[0] << 32) | often[1]) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - store.SLOTS)
        if place.get(slot, often) != often:
            break
        place[slot] = often
    docs = [np.array(often, "<u4")] * 500 + [np.array(place[slot], "<u4")]
    starts = np.arange(0, 2 * len(docs), 2)
    rules, _, symbols, _ = store.compress(np.concatenate(docs), starts, 5000, rounds=1)
    assert place[slot] != often and rules.tolist() == [often] and len(symbols) == 502


def test_a_word_before_a_comma_is_not_encoded_again(monkeypatch):
    import public_tokenizers
    from stockloom.llm.tokens import TextEncoder

    encoder = TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    made, tokenize = [], encoder._tokenize
    encoder._tokenize = lambda word: made.append(word) or tokenize(word)
    text = "a quobbling quobbling, then quobbling. quobbling"
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert list(memoryview(encoder.encode(text)).cast("I")) == whole
    assert sorted(w[1:] for w in made) == ["quobbling", "then"]


def test_marks_after_a_word_are_made_once_by_the_model(monkeypatch):
    """Runs of marks after a word of any letters, at line ends too, do not go through the whole library."""
    encoder = TextEncoder(VOCABULARY)
    text = "a quibblön*** quibblön&&& quibblön, größe;; größe!?\nbé... größe\u0301 x_ y'' z's\u00b2 q\u00bd *** 9,, quibblön***"
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    asked, library = [], encoder._whole
    monkeypatch.setattr(encoder, "_whole", lambda part: asked.append(part) or library(part))
    assert list(memoryview(encoder.encode(text)).cast("I")) == whole
    assert not [part for part in asked if "quibblön" in part or "größe;" in part]


def test_spare_memory_is_given_back_after_the_last_slice(monkeypatch):
    import pyarrow as pa
    from stockloom.llm import text_batches

    calls = []
    monkeypatch.setattr(text_batches, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["ab", "cd", None]})
    slices = text_batches.sliced([batch], "text", max_bytes=2)
    assert next(slices).num_rows == 1 and not calls
    assert sum(b.num_rows for b in slices) == 2 and calls == [1]
