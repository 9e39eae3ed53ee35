"""Alignment of two tokenizers against a plain walk over bytes."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from frames import SCHEMA, clashing, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from haulier.llm import token_alignment
from haulier.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """(ids, bytes) of both tokenizers, straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}

    def tokens(text):
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        a_bytes = [bytes(of[c] for c in tokenizer.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode()
        return (a, a_bytes, b, b_bytes) if text and b"".join(a_bytes) == whole == b"".join(b_bytes) else ([], [], [], [])

    return tokens


def walked(a, a_bytes, b, b_bytes):
    """(groups as text, number of groups, linked id pairs) by looking at every byte."""
    def owners(parts):
        return [i for i, part in enumerate(parts) for _ in part]

    links = sorted(set(zip(owners(a_bytes), owners(b_bytes), strict=True)))
    ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        i, j = k, m
    return ";".join(groups), len(groups), [(a[x], b[y]) for x, y in links]


def expected(texts, tokens):
    found = [walked(*tokens(text or "")) for text in texts]
    counts = Counter(pair for _, _, pairs in found for pair in pairs)
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    for text, (groups, n, pairs) in zip(texts, found, strict=True):
        a, _, b, _ = tokens(text or "")
        digest = hashlib.sha256(groups.encode()).hexdigest() if a else ""
        yield len(a), len(b), n, len(pairs), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs), digest


@pytest.mark.parametrize("frequent", [0, 40, 500_000])
def test_documents_of_every_kind(spark, plain, frequent):
    extra = [(800 + i, t, "en", "a", 1) for i, t in enumerate(["a\nb\n\nc", "  two  spaces ", "<s>x</s> <|endoftext|> y", "①ﬁ é  x\ty", "a▁b", "\ta", " ", "日本語テキスト" * 300, "xyzzyx" * 4000, "a\0b"])]
    df = documents(spark, extra)
    rows = df.collect()
    want = sorted(repr((r["doc_id"], *x)) for r, x in zip(rows, expected([r["text"] for r in rows], plain), strict=True))
    got = token_alignment.document_alignments(clashing(df).repartition(3), A, B, frequent=frequent).collect()
    assert sorted(repr(tuple(r)) for r in got) == want
    assert sum(r["n_a"] == 0 for r in got) > 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=60), min_size=1, max_size=5))
def test_groups_are_cut_at_every_shared_end(texts):
    """Each byte has a flag per side: whether a token ends there; the last byte ends both."""
    ends, starts = ([], []), ([0], [0])
    at, want = 0, 0
    for flags in texts:
        flags = [*flags[:-1], (True, True)] if flags else []
        want += sum(x and y for x, y in flags)
        for side in (0, 1):
            ends[side].extend(at + i + 1 for i, f in enumerate(flags) if f[side])
            starts[side].append(len(ends[side]))
        at += len(flags)
    a, b = (np.array(x, dtype=np.int64) for x in ends)
    groups = token_alignment.shared_groups(a, b, np.array(starts[0]), np.array(starts[1]))
    assert len(groups) == want == len(set(ends[0]) & set(ends[1]))
    for i, j, k, m in groups.tolist():
        assert a[j - 1] == b[m - 1] and (not i or a[i - 1] == b[k - 1])
    link_a, link_b = token_alignment.overlaps(a, b)
    assert len(link_a) == len(a) + len(b) - len(groups)


def test_an_empty_table(spark):
    assert token_alignment.document_alignments(spark.createDataFrame([], SCHEMA), A, B).count() == 0
