import base64
import random

import public_tokenizers
import pytest
import tiktoken

from llm_fixtures import edge_docs, no_docs, small_docs  # noqa: F401

from repotrend.llm import prefix_bpe as pb

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return pb.Vocabulary.load(PATH)


def texts():
    rng = random.Random(5)
    some = ["", " ", "  \n\n  x", "don't  we'll\tgo", "été 𝄞 漢字かな עברית", "a" * 3000, "=" * 2000, "ab" * 1500, "1234567890" * 50, "\x1c \x85 x", "<|endoftext|>"]
    letters = "aeiounrst lmhd\n'.é9"
    return some + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 300))) for _ in range(200)]


def test_same_ids_as_the_library(spark, library, small_docs):
    rows = [(k, t) for k, t in enumerate(texts())] + [(1000 + r.doc_id, r.text) for r in small_docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = pb.decode(pb.encode(df, PATH, public_tokenizers.PATTERN), PATH)
    got = {r.doc_id: (list(r.ids), bytes(r.decoded)) for r in out.collect()}
    assert got == {i: (library.encode_ordinary(t), t.encode()) for i, t in rows}


def test_every_prefix(vocabulary, library):
    data = "unbelievably interesting, naïveté  and so on".encode()
    table = pb.PrefixEncoding(vocabulary, data)
    for end in range(1, len(data) + 1):
        assert table.tokens(end) == library._encode_single_piece(data[:end]) or data[:end] in vocabulary.ranks
        assert b"".join(vocabulary.bytes_of[t] for t in table.tokens(end)) == data[:end]


def test_tables_side_by_side(vocabulary, library):
    rng = random.Random(9)
    letters = ["a", "e", "i", "n", "t", " ", "é", "漢", "и", "'", "1", "\n", "Q", "zz"]
    pieces = [b"".join(rng.choice(letters).encode() for _ in range(rng.randrange(1, 11)))[: pb.SHORT] for _ in range(3000)] + [b"\xff\x00", b"a", b"a" * 32]
    for piece, last in zip(pieces, vocabulary.tables(pieces), strict=True):
        plain = []
        vocabulary.extend(piece, plain, len(piece))
        assert last == plain
    assert vocabulary.tables([]) == []


def test_pieces_are_known_until_the_next_call(vocabulary, monkeypatch):
    monkeypatch.setattr(pb, "CACHED_PIECES", 10)
    known = pb._Pieces(vocabulary)
    rng = random.Random(3)
    for _ in range(20):
        own = {"".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(1, 50))) for _ in range(12)}
        known.learn(own)
        for piece in own:
            last = []
            vocabulary.extend(piece.encode(), last, len(piece))
            token = vocabulary.ranks.get(piece.encode())
            assert known[piece] == ((token,) if token is not None else tuple(vocabulary.path(last, len(piece))))
    assert len(known) <= 5 + 12


def test_appends_and_edits(vocabulary):
    rng = random.Random(2)
    data = bytes(rng.choice(b"etaoinshr ") for _ in range(3000))
    table = pb.PrefixEncoding(vocabulary)
    for k in range(0, 3000, 70):
        table.append(data[k : k + 70])
    assert table.tokens() == pb.PrefixEncoding(vocabulary, data).tokens()
    redone = table.replace(1500, 1503, b"queen")
    assert table.data == data[:1500] + b"queen" + data[1503:] and redone < 600
    assert table.tokens() == pb.PrefixEncoding(vocabulary, table.data).tokens()


def test_text_appends(vocabulary, library):
    for text in texts()[:60]:
        grown, rng = pb.TextEncoding(vocabulary, public_tokenizers.PATTERN), random.Random(len(text))
        at = 0
        while at < len(text):
            step = rng.randrange(1, 40)
            grown.append(text[at : at + step])
            at += step
            assert grown.tokens() == library.encode_ordinary(text[:at])


def test_edge_rows(edge_docs, no_docs, library):
    out = pb.encode(edge_docs, PATH, public_tokenizers.PATTERN, keep_text=True, with_decoded=True).collect()
    assert len(out) == edge_docs.count()
    assert all(list(r.ids) == library.encode_ordinary(r.text) and bytes(r.decoded) == r.text.encode() for r in out)
    assert pb.encode(no_docs, PATH, public_tokenizers.PATTERN).count() == 0
