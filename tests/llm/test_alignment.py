"""Alignment of two tokenizers against a token-by-token version."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from epilake.llm.alignment import Tokenizers, align
from epilake.llm.queries import byte_tokenizer, op11_alignment, piece_tokenizer
from epilake.llm.tables import table

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute_force(rows: list[tuple]) -> list[tuple]:
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(byte_tokenizer())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=piece_tokenizer())
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {chr(x): x for x in visible}
    letter |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in visible)}

    def piece(i: int) -> bytes:
        name = b.id_to_piece(i)
        return bytes([int(name[3:-1], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def tokens(text: str | None) -> tuple[list, list]:
        if not text:
            return [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        split = [(i, bytes(letter[c] for c in a.id_to_token(i))) for i in ids_a], [(i, piece(i)) for i in ids_b]
        whole = (" " + text).encode()
        return split if all(b"".join(x for _, x in s) == whole for s in split) else ([], [])

    def ends(found: list[tuple[int, bytes]]) -> dict[int, int]:
        at, out = 0, {}
        for k, (_, spelled) in enumerate(found):
            at += len(spelled)
            out[at] = k
        return out

    split = [tokens(text) for _, text in rows]
    linked, counts = [], Counter()
    for one, two in split:
        ends_a, ends_b = ends(one), ends(two)
        common = sorted(ends_a.keys() & ends_b.keys())
        linked.append([(ends_a[e], ends_b[e]) for e in common])
        counts.update((one[i][0], two[j][0]) for i, j in linked[-1])
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for (doc_id, _), (one, two), links in zip(rows, split, linked, strict=True):
        groups, i0, j0 = [], 0, 0
        for i, j in links:
            groups.append(",".join(str(x) for x, _ in one[i0 : i + 1]) + "|" + ",".join(str(x) for x, _ in two[j0 : j + 1]))
            i0, j0 = i + 1, j + 1
        held = [counts[one[i][0], two[j][0]] for i, j in links]
        best = sum(n == most[two[j][0]] for n, (_, j) in zip(held, links, strict=True))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if one else ""
        out.append((doc_id, len(one), len(two), len(groups), len(links), best, sum(held), digest))
    return out


def same(found, rows: list[tuple]) -> None:
    order = lambda x: (x[0] is None, x)
    assert sorted((tuple(r) for r in found.select(*NAMES).collect()), key=order) == sorted(brute_force(rows), key=order)


RULE = Tokenizers(byte_tokenizer(), piece_tokenizer())


def test_small_texts(documents):
    rows = [
        (1, "The cat sat on the mat."),
        (2, "The cat sat on the mat."),
        (3, ""),
        (4, None),
        (5, " "),
        (6, "a  b\n\n\tc   "),
        (7, "naïve café 東京 🙂 ́x"),
        (8, "▁ is a space to one of them"),
        (9, "<|endoftext|> <s> </s> <unk> <0x41>"),
        (10, "\x00\x7f "),
        (10, "an id again"),
        (None, "no id"),
        (None, "no id"),
        (11, "  two before"),
    ]
    same(align(documents(*rows), RULE), rows)


@pytest.mark.parametrize("partitions", [1, 7])
def test_slices_do_not_matter(documents, monkeypatch, partitions):
    rows = [(k, "word " * (k % 50) + f"number {k} of many" * (k % 3)) for k in range(120)]
    same(align(documents(*rows, partitions=partitions), RULE), rows)


def test_a_very_long_text(documents):
    rows = [(1, "so long a text, and no end. " * 60_000), (2, "x" * 3000), (3, "short")]
    same(align(documents(*rows), RULE), rows)


def test_no_rows_and_clashing_columns(documents):
    assert align(documents((1, "a")).where("false"), RULE).collect() == []
    more = documents((1, "a b c")).withColumns({c: F.lit(5) for c in ("slice", "pair", "place", "n", "held", "kind")})
    same(align(more, RULE), [(1, "a b c")])


def test_the_query_is_its_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    same(op11_alignment(spark, sf_dir), rows)
