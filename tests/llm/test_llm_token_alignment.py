import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fraudlens.llm import token_alignment
from fraudlens.llm.token_alignment import COUNTS, align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(rows, libraries):
    """Every link of every document, from the two libraries and plain dictionaries."""
    a_lib, b_lib = libraries
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {chr(b): b for b in printable}
    letter |= {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    read, count = [], Counter()
    for i, text in rows:
        whole, groups, links, na, nb = b" " + (text or "").encode(), [], [], 0, 0
        if text:
            a = [(t, bytes(letter[c] for c in a_lib.id_to_token(t))) for t in a_lib.encode(" " + text, add_special_tokens=False).ids]
            b = []
            for t in b_lib.encode(text):
                p = b_lib.id_to_piece(t)
                b.append((t, bytes([int(p[3:5], 16)]) if b_lib.is_byte(t) else p.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                na, nb, ga, gb, ea, eb, b = len(a), len(b), [], [], 0, 0, b[::-1]
                for t, x in a:
                    ga.append(t)
                    ea += len(x)
                    while b and eb + len(b[-1][1]) <= ea:
                        gb.append(b[-1][0])
                        eb += len(b.pop()[1])
                    if ea == eb:
                        links.append((t, gb[-1]))
                        groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                        ga, gb = [], []
        count.update(links)
        read.append((i, na, nb, groups, links))
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return sorted(((i, na, nb, len(g), len(k), sum(count[x] == top[x[1]] for x in k), sum(count[x] for x in k),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, na, nb, g, k in read), key=str)


def result(df):
    return sorted((tuple(r) for r in align(df, A, B).select("doc_id", *COUNTS, "groups_sha256").collect()), key=str)


def test_equals_brute_force(frame, vocabulary, libraries):
    r = random.Random(11)
    odd = ["don't", "été", "你好吗", "\U0001f600\U0001f3fd", "3.14159", "  ", "\n\n", "\t", "HTTPServer_v2", "<|endoftext|>", "<s>", "</s>", "​", "İ", "näive"]
    rows = [(i, " ".join(r.choice(odd if r.random() < 0.2 else vocabulary) for _ in range(r.randint(1, 60)))) for i in range(80)]
    rows += [(100 + k, rows[k][1]) for k in range(10)]
    assert result(frame(rows)) == brute(rows, libraries)


def test_nulls_empty_long_changed_and_repeated(frame, libraries):
    long = " ".join(f"word{i} café" for i in range(8_000))
    rows = [(1, None), (2, ""), (3, long), (4, long), (4, long), (None, "a b"), (None, None), (5, "a▁b"), (6, " "), (7, "a" * 5_000),
            (8, "ﬁne"), (9, "\x00\x01"), (10, "x"), (10, "y")]
    got = result(frame(rows))
    assert got == brute(rows, libraries)
    assert (5, 0, 0, 0, 0, 0, 0, "") in got      # U+2581 in a text would read as a space


def test_empty_table(frame):
    assert result(frame([])) == []


def test_encoder_equals_the_library_on_every_character(libraries):
    lib, mine = libraries[0], token_alignment.ranked(open(A, "rb").read())
    texts = [f" a{c}b {c}{c} 1{c}2 .{c}!" for c in map(chr, [*range(0xD800), *range(0xE000, 0x30000)])]
    other = [t for t, e in zip(texts, lib.encode_batch(texts, add_special_tokens=False)) if e.ids != mine.encode_ordinary(t)]
    assert other == []


def test_encoder_equals_the_library_on_random_strings(libraries):
    lib, mine, r = libraries[0], token_alignment.ranked(open(A, "rb").read()), random.Random(5)
    letters = "aaaaabbcdehinorst  AEN\n'01é中"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(1, 40))) for _ in range(20_000)]
    assert [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)] == list(map(mine.encode_ordinary, texts))


def test_identity_map_names_the_same_bytes():
    aligner = token_alignment.Aligner(open(A, "rb").read(), open(B, "rb").read())
    known = np.flatnonzero(aligner.same >= 0)
    assert len(known) > 10_000
    assert all(aligner.a_bytes[i] == aligner.b_bytes[aligner.same[i]] for i in known)
