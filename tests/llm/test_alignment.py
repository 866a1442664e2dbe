from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from cases import documents, sample, stored, texts, words
from tokenizers import Tokenizer

from stockloom.llm import token_alignment
from stockloom.llm.token_alignment import align_documents, op12_token_alignment

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)


PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BACK = {chr(b): b for b in PLAIN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in PLAIN)}


def a_bytes(i: int) -> bytes:
    return bytes(BACK[c] for c in A.id_to_token(i))


def b_bytes(i: int) -> bytes:
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def spans(ids, token_bytes):
    out, at = [], 0
    for i in ids:
        out.append((at, at := at + len(token_bytes(i)), i))
    return out


def plain_alignment(text):
    """Groups as text, and a Counter of links between ids; each token of A is compared with each of B near it."""
    if not text:
        return 0, 0, [], Counter()
    a = spans(A.encode(" " + text, add_special_tokens=False).ids, a_bytes)
    b = spans(B.encode(text), b_bytes)
    if not b"".join(a_bytes(t[2]) for t in a) == (" " + text).encode() == b"".join(b_bytes(t[2]) for t in b):
        return 0, 0, [], Counter()
    links, j = Counter(), 0
    for start, end, i in a:
        while b[j][1] <= start:
            j += 1
        k = j
        while k < len(b) and b[k][0] < end:
            links[i, b[k][2]] += 1
            k += 1
    shared, groups = {t[1] for t in a} & {t[1] for t in b}, []
    for side in (a, b):
        own = [[]]
        for _, end, i in side:
            own[-1].append(str(i))
            if end in shared:
                own.append([])
        groups.append([",".join(g) for g in own[:-1]])
    return len(a), len(b), list(zip(*groups, strict=True)), links


def plain_rows(rows):
    found = [(i, plain_alignment(t)) for i, t in rows]
    total = Counter()
    for _, (_, _, _, links) in found:
        total.update(links)
    best = Counter()
    for (_, b), n in total.items():
        best[b] = max(best[b], n)
    out = []
    for i, (n_a, n_b, groups, links) in found:
        text = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if n_a else ""
        n_best = sum(n for p, n in links.items() if total[p] == best[p[1]])
        out.append((i, n_a, n_b, len(groups), sum(links.values()), n_best, sum(n * total[p] for p, n in links.items()), text))
    return out


ODD = [
    "a  b", " a", "a ", "a\n b", "x▁y", "▁", "x\x00y", "　b", "a\r\nb\tc ", "日本語 <s> </s><unk>", "<|endoftext|> a <0x41>", " ", "  ", "é é",
    "a  b c", "\x1c x \x85 y", "\U0001f600\U0001f600 naïve", "\n\n \n", "tab\t \tend", "don't  'll x's",
]


def compare(found, expected):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    found = [tuple(r[n] for n in names) for r in found]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_awkward_rows_equal_plain_alignment(spark):
    rows = [*texts(), *((100 + i, t) for i, t in enumerate(ODD))]
    compare(align_documents(documents(spark, rows), A_PATH, B_PATH).collect(), plain_rows(rows))
    assert align_documents(documents(spark, []), A_PATH, B_PATH).collect() == []
    compare(align_documents(documents(spark, [(1, None), (None, "")]), A_PATH, B_PATH).collect(), plain_rows([(1, None), (None, "")]))


def test_stretches_and_chunks_change_nothing(monkeypatch):
    rows = [(1, words(900, 2)), (2, "x" * 700 + "日本" * 300), (3, None), (4, "a b c"), (5, words(50, 1) + "\n" * 300), (6, "▁ a")]

    def run():
        both = token_alignment.TwoTokenizers(A_PATH, B_PATH)
        out, chunk = [], token_alignment._Chunk()
        for i, t in rows:
            chunk.add(i, t, both)
            if chunk.full():
                out.append(chunk.batch(len(out), both))
                chunk = token_alignment._Chunk()
        out += [chunk.batch(len(out), both)] if chunk.ids else []
        pairs = Counter()
        for batch in out:
            pairs.update(dict(zip(batch.column("codes")[0].as_py(), batch.column("times")[0].as_py(), strict=True)))
        return [r for b in out for r in b.select(token_alignment._ALIGNED[1:7]).to_pylist()], pairs

    whole, pairs = run()
    expected = plain_rows(rows)
    assert [tuple(r.values()) for r in whole] == [(*r[:5], r[7]) for r in expected]
    for stretch, chunk in ((64, 10), (128, 5000), (512, 300)):
        monkeypatch.setattr(token_alignment, "STRETCH", stretch)
        monkeypatch.setattr(token_alignment, "CHUNK", chunk)
        monkeypatch.setattr(token_alignment, "KEPT", 20)
        assert run() == (whole, pairs)


def test_query_equals_plain_alignment(spark, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in sample()][:90]
    folder = stored(spark, tmp_path, documents=documents(spark, rows))
    compare(op12_token_alignment(spark, folder).collect(), plain_rows(rows))
