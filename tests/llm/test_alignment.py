"""Alignment of two tokenizers against plain loops over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import documents
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from starmart.llm.alignment import (
    BYTE_TOKENIZER, PIECE_TOKENIZER, Pieces, Vocabulary, _distinct_links, align_tokenizers, farthest_tokens,
)
from starmart.llm.queries import QUERIES
from starmart.llm.tokens import AS_CHARACTER

AS_BYTE = {chr(c): b for b, c in AS_CHARACTER.items()}


@pytest.fixture(scope="module")
def plain_tokens():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def tokens(text):
        """(id, bytes) of both tokenizers, the whole text at once."""
        a = first.encode(" " + text, add_special_tokens=False)
        b = second.encode(text, out_type=int)
        in_a = [(i, bytes(AS_BYTE.get(c, ord(c)) for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)]
        in_b = []
        for i in b:
            piece = second.id_to_piece(i)
            in_b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        return in_a, in_b

    return tokens


def plain_groups(in_a, in_b):
    def ends(tokens):
        at, out = 0, []
        for _, data in tokens:
            at += len(data)
            out.append(at)
        return out

    ends_a, ends_b = ends(in_a), ends(in_b)
    groups, a, b = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        i, j = ends_a.index(end, a) + 1, ends_b.index(end, b) + 1
        groups.append(([t for t, _ in in_a[a:i]], [t for t, _ in in_b[b:j]]))
        a, b = i, j
    return groups


def brute_force(rows, tokens):
    """Every (doc, text) as (doc, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    found = []
    for doc, text in rows:
        in_a, in_b = tokens(text) if text else ([], [])
        want = (" " + text).encode() if text else b""
        if any(b"".join(d for _, d in side) != want for side in (in_a, in_b)):
            in_a, in_b = [], []
        groups = plain_groups(in_a, in_b)
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        found.append((doc, len(in_a), len(in_b), groups, links))
    counts = Counter(pair for *_, links in found for pair in links)
    highest = Counter()
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    return [
        (
            doc, n_a, n_b, len(groups), sum(links.values()),
            sum(n for p, n in links.items() if counts[p] == highest[p[0]]), sum(n * counts[p] for p, n in links.items()),
            ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups),
        )
        for doc, n_a, n_b, groups, links in found
    ]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def compare(found, want, text="groups"):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[c] for c in (*COLUMNS, text)) for r in found), key=key) == sorted(want, key=key)


def odd_texts():
    rng = random.Random(3)
    words = "the naïve Straße don't we'll übermäßig 12345 3.14 ... == <s> </s> <|endoftext|> 日本語 😀 zz'tis".split()
    texts = [
        None, "", " ", "  ", "a", " a", "a ", "  two  spaces  ", "tab\tand\nline", "\n\n x \r\n", "a b  c",
        "mark ▁ here", "\x00 zero", "é ﻿  ", "\x1c a \x85 b", "don 't we 'll", "x" * 300, "ab" * 5000,
        "日本語" * 100, "a  b   c    d " * 20, "\u0000", "(((( )))) [[ ]]", "1 2 33 444 5555 1 2",
    ]
    for _ in range(40):
        parts = rng.choices(words, k=rng.randint(1, 60))
        texts.append("".join(p + rng.choice([" ", " ", " ", "  ", "\n", "\t", "", " \n"]) for p in parts))
    texts += texts[-3:]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, "id again")]


def test_odd_texts_against_brute_force(spark, plain_tokens):
    rows = odd_texts()
    found = align_tokenizers(documents(spark, rows).repartition(4))
    compare(found.collect(), brute_force(rows, plain_tokens))


def test_the_given_table_against_brute_force(spark, plain_tokens):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = [
        (*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute_force(rows, plain_tokens)
    ]
    compare(QUERIES["op11_alignment"](spark, sf_dir).collect(), want, "groups_sha256")


def test_chunks_do_not_change_the_result(spark, plain_tokens, monkeypatch):
    import starmart.llm.alignment as alignment

    rows = [(i, f"the {w} of the {w}{w}") for i, w in enumerate(["cat", "dog", "Maus", "cat"] * 30)]
    monkeypatch.setattr(alignment, "CHUNK_PAIRS", 8)
    found = alignment.align_tokenizers(documents(spark, rows))
    compare(found.collect(), brute_force(rows, plain_tokens))


def test_empty_table_and_clashing_names(spark, plain_tokens):
    empty = align_tokenizers(documents(spark, []))
    assert empty.count() == 0 and {*COLUMNS, "groups"} == set(empty.columns)
    rows = [("x", "one two", 5, "g"), ("y", None, 6, "h")]
    odd = spark.createDataFrame(rows, "`my.id` string, Text string, N_A int, groups string")
    found = align_tokenizers(odd, id="my.id", text="Text").collect()
    want = brute_force([("x", "one two"), ("y", None)], plain_tokens)
    assert sorted((r["my.id"], *(r[c] for c in (*COLUMNS[1:], "groups"))) for r in found) == sorted(want)


def test_invalid_text_has_no_tokens(spark):
    frame = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF62') AS string) AS text")
    row = align_tokenizers(frame).first()
    assert (row.n_a, row.n_b, row.n_links, row.groups) == (0, 0, 0, "")


def test_pointer_jumping_labels_long_groups():
    # Tokens of two and of two shifted by one overlap in one chain to the end.
    n = 1000
    a, b = np.arange(2, 2 * n + 1, 2), np.append(np.arange(1, 2 * n, 2), 2 * n)
    assert set(farthest_tokens(a, b).tolist()) == {n - 1}
    assert farthest_tokens(np.array([3, 5, 9]), np.array([1, 3, 9])).tolist() == [0, 2, 2, 0, 0, 2]
    assert len(farthest_tokens(np.zeros(0, int), np.zeros(0, int))) == 0


def test_links_of_a_wide_group():
    pairs, times = _distinct_links(np.array([1, 1, 2]), np.array([7, 8, 7]))
    assert dict(zip(pairs.tolist(), times.tolist(), strict=True)) == {
        1 << 32 | 7: 4, 1 << 32 | 8: 2, 2 << 32 | 7: 2, 2 << 32 | 8: 1,
    }


def test_frequent_pieces_are_aligned_once(monkeypatch):
    import starmart.llm.alignment as alignment

    monkeypatch.setattr(alignment, "KEPT_BYTES", 20_000)
    known, aligned = Pieces(BYTE_TOKENIZER, PIECE_TOKENIZER), Counter()
    align = known._align
    monkeypatch.setattr(known, "_align", lambda pieces, *more: (aligned.update(pieces), align(pieces, *more)))
    shown = set()
    for i in range(40):
        (places,) = known.of([["the", *(f"rare{i}x{j}" for j in range(20))]])
        shown.add((known.now.groups[places[0]], *known.now.counts.held[places[0]].tolist()))
    assert aligned["the"] == 1 and len(shown) == 1 and len(aligned) == 801
    assert len(known.now.places) + len(known.before.places) < 200


def test_pieces_given_together_have_the_tokens_of_each(monkeypatch):
    rng = random.Random(5)
    firm = ["the", "don't", "a\tb", "naïve", "日本語", "<|endoftext|>", "1\n2", "x" * 90, "fi", "\x00", "▁", "a\u200bb"]
    firm += ["".join(rng.choices("abcdez'.,(ñ", k=rng.randint(1, 9))) for _ in range(500)]
    loose = [" a", "b ", "\n", "  ", "c\n\n"]
    pieces = [*dict.fromkeys(firm), *loose]
    texts = [f" {p}".encode() for p in pieces]
    for name in (BYTE_TOKENIZER, PIECE_TOKENIZER):
        vocabulary, given = Vocabulary(name), []
        tokenize = vocabulary._ids
        monkeypatch.setattr(vocabulary, "_ids", lambda some, f=tokenize, g=given: (g.append(len(some)), f(some))[1])
        ids, counts = vocabulary.encode(pieces, len(pieces) - 5, b"".join(texts), np.cumsum(list(map(len, texts))))
        until = np.cumsum(counts).tolist()
        found = [ids[i:j].tolist() for i, j in zip([0, *until], until, strict=False)]
        each = [ids if b"".join(vocabulary.bytes[i] for i in ids) == t else [] for ids, t in zip(tokenize(pieces), texts)]
        assert found == each
        if name == BYTE_TOKENIZER:
            assert given == [-(-(len(pieces) - 5) // 64) + 5]
        else:
            assert [] in found  # what this tokenizer changes has no tokens
