import numpy as np
import pytest

from tidemark.llm import bpe
from tidemark.llm.queries import bpe_path

tokenizers = pytest.importorskip("tokenizers")
ODD = [
    "", None, "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "  x  \n\n y\t ", "\u3000\x85\x1c\x1dz \u00a0 a", "l'été 'RE we've I'LL ½ ² ٣ Ⅷ 字漢 😀👍🏽",
    "x" * 3000, "ab" * 5000, "   ", " a", "\ufeffq\u200b r\r\n", "'s's 't 'store ''s d'", "\n's", " '", "<|endof", "x  <|endoftext|>'s", "don't we'lld",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = tokenizers.Tokenizer.from_file(bpe_path())
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def test_equals_the_library(docs, library, rng):
    pool = list(" \n\t'aZ1é字!<|>strevmlld") + ["'s", "  ", "<|endoftext|>", "'ll", "the", " of"]
    texts = ODD + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    coded = bpe.encode_texts(docs(list(enumerate(texts))), bpe_path(), keep=("doc_id", "score"), lexicon_words=50).collect()
    assert len(coded) == len(texts)
    for row in coded:
        expected = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == expected and row["n_tokens"] == len(expected)
        assert row["decoded"] == library.decode(expected, skip_special_tokens=False) == (texts[row["doc_id"]] or "")


def test_classes_of_all_characters(library):
    classes, split = bpe.character_classes(), library.pre_tokenizer.pre_tokenize_str
    one = lambda text: len(split(text)) == 1
    for c in [*range(0x3100), *range(0xA000, 0xD800, 7), *range(0xE000, 0x110000, 97), *(x for pair in bpe.LETTERS_16 + bpe.NUMBERS_16 for x in pair)]:
        kind = bpe.LETTER if one("a" + chr(c)) else bpe.NUMBER if one("1" + chr(c)) else bpe.OTHER if one("!" + chr(c)) else bpe.SPACE
        assert classes[c] == kind, hex(c)


def test_lexicon_is_minimal_and_exact():
    words = [b"tap", b"taps", b"top", b"tops", b"a", b"\xff\x00"]
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words, lambda w: [len(w), w[0]]))
    assert lexicon.find([*words, b"", b"t", b"tapsx", b"b" * 99]) == [[len(w), w[0]] for w in words] + [None] * 4
    # Start, t, (ta|to), p with an optional s, and one end.
    assert len(lexicon.final) == 6
    assert bpe.Lexicon(bpe.compile_lexicon([], list)).find([b"a", b""]) == [None, None]


def test_merging_together_equals_merging_one_by_one(rng):
    vocabulary = bpe.Vocabulary.load(bpe_path())
    encoder = bpe.Encoder(vocabulary, bpe.compile_lexicon([], vocabulary.merge))
    words = [bytes(rng.choice(b"  theaonirs'\xc3\xa9!1") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    assert encoder.merge(words) == [vocabulary.merge(w) for w in words]


def test_words_with_one_hash_are_told_apart(monkeypatch, library):
    vocabulary = bpe.Vocabulary.load(bpe_path())
    encoder = bpe.Encoder(vocabulary, bpe.compile_lexicon([], vocabulary.merge))
    monkeypatch.setattr(bpe, "range_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    data = np.frombuffer(b"one two three", np.uint8)
    ids, counts, decoded = encoder.exactly(data, np.array([0, 13]))
    assert ids.tolist() == library.encode("one two three").ids and decoded.tobytes() == b"one two three"


def test_frequent_words_keep_to_the_limit(docs):
    vocabulary = bpe.Vocabulary.load(bpe_path())
    frame = docs([(1, "aa aa aa aa aa aa aa aa bb bb bb cc dd dd"), (2, None)])
    assert set(bpe.frequent_words(frame, vocabulary)) == {b" aa", b" bb", b" dd"}
    assert bpe.frequent_words(frame, vocabulary, limit=1) == [b" aa"]
    assert bpe.encode_texts(docs([]), bpe_path()).collect() == []
