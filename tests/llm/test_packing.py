import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quotewright.llm import packing
from quotewright.llm.queries import tokenizer_path
from tests.llm import helpers


def token_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [[*each.ids, 0] for each in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize(
    "text",
    ["<|endoftext|>", "x<|endoftext|>y", "a b <|endoftext|> c", "<|endoftext|> a", "a\n<|endoftext|>\nb", "a <|endoftext|", "é<|endoftext|>é " * 300],
)
def test_special_strings_are_what_the_tokenizer_makes_of_them(text):
    own = np.frombuffer(packing.TokenBytes(tokenizer_path()).encode(text), dtype="<u4").tolist()
    assert [*own, 0] == token_ids([text])[0]


@pytest.mark.parametrize("group", [20, 4096])
def test_pieces_and_sequences(spark, group):
    docs = helpers.documents(spark)
    rows = packing.pack_documents(docs, tokenizer_path(), group=group).collect()
    expected = Counter()
    given = [(row["doc_id"], row["text"] or "") for row in docs.collect()]
    for (doc_id, _), ids in zip(given, token_ids([text for _, text in given])):
        first = len(ids) % 2048 or 2048
        starts = [0, *range(first, len(ids), 2048)] if len(ids) > 2048 else [0]
        for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            crc = zlib.crc32(np.array(ids[start:end], "<u4").tobytes())
            expected[(doc_id, piece, start, end - start, crc)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_no_rows(spark):
    assert packing.pack_documents(helpers.empty(spark), tokenizer_path()).count() == 0


def test_words_are_tokenized_as_in_their_text():
    texts = ["It's  a\n\nb", "a \nb", " lead", "trail ", "x.\nY's, 12ab", "a\tb\x1cc", "ñandú über. Straße, 東京 x²", "\n", "a　 b", "don't'd a'll"]
    texts += [" ".join(f"{a}{b}" for a in "ab.é" for b in "1,'\nZ")]
    tokens = packing.TokenBytes(tokenizer_path())
    assert [tokens.encode(text) for text in texts] == [np.array(ids[:-1], "<u4").tobytes() for ids in token_ids(texts)]


def test_slices_and_a_full_cache_change_nothing(monkeypatch):
    text = " ".join(f"w{i % 97}é{i}." for i in range(3000))
    whole = packing.TokenBytes(tokenizer_path()).encode(text)
    monkeypatch.setattr(packing, "SLICE_CHARS", 101)
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    assert packing.TokenBytes(tokenizer_path()).encode(text) == whole


def test_search_fills_what_best_fit_leaves_open():
    # Best fit puts 6 and 4 together and leaves three bins; 6+2+2, 5+5 need two.
    lengths = [5, 4, 4, 3, 2, 2]
    bins = packing.Bins(lengths, 10)
    before = sum((10 - room) ** 2 for room in bins.room)
    bins.improve()
    assert sum((10 - room) ** 2 for room in bins.room) >= before
    assert sorted(i for own in bins.items for i in own) == list(range(6)) and len(bins.items) == 2


def test_search_empties_bins():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 60, 200).tolist()
        bins = packing.Bins(lengths, 100)
        # A bad start: one document to a bin.
        bins.items, bins.room = [[i] for i in range(200)], [100 - n for n in lengths]
        bins.improve()
        assert all(sum(lengths[i] for i in own) + room == 100 and room >= 0 for own, room in zip(bins.items, bins.room))
        assert sorted(i for own in bins.items for i in own) == list(range(200))
        assert len(bins.items) <= sum(lengths) / 100 * 1.1 + 1
