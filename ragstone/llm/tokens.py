"""Fast use of a public tokenizer file: texts are cut between words, and each distinct word is encoded once.

Both public patterns treat a single space or line end between two non-space characters as a place
that no pre-token spans from the left: the ids of a text are the ids of its words (each with the
space before it, where the vocabulary keeps spaces), concatenated. Texts with other white space are
cut by a regular expression at just such places. Words are remembered in a bounded store.

Plain byte-level files need no words: the same vocabulary, read as ranks, is merged over whole texts
by the tiktoken library. Over all code points its ids are those of the tokenizers library.
"""

from __future__ import annotations

import array
import json
import re
import string
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_ODD = re.compile(r"\s\s")
#: Letters that stay one letter in any normal form and case, so that what follows them never joins them.
_PLAIN = frozenset(c for c in map(chr, range(0x3000)) if c.isalpha() and len(x := unicodedata.normalize("NFC", c).lower()) == 1 and x.isalpha())
_LATIN = frozenset(c for c in _PLAIN if c < "\u0250")
#: Words that a worker remembers.
MOST_WORDS = 600_000


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_of(text: str) -> list[str]:
    """``text`` as pieces whose ids are the text's ids; joined they are the text.

    Each piece begins with at most the one space or line end before its word.
    """
    if "\0" in text or _ODD.search(text):
        return _CUT.split(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


def bare_pieces_of(text: str) -> list[str]:
    """The same for vocabularies that drop white space: the words alone."""
    return text.replace("\n", " ").split(" ")


class _Codes(dict):
    """A number for each piece; new pieces get the next one and are noted."""

    def __init__(self, pieces=()):
        super().__init__((p, i) for i, p in enumerate(pieces))
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = code = len(self)
        self.new.append(piece)
        return code


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit bytes), word by word.

    ``learn`` gets distinct pieces and returns the bytes of each. The ids of all known pieces stand
    end to end in one array; a text's pieces are looked up once, and its ids taken from there all at
    once. Beyond ``most`` pieces the half that was used most stays.
    """

    def __init__(self, cut: Callable[[str], list[str]], learn: Callable[[list[str]], list[bytes]], most: int = MOST_WORDS):
        self.cut, self.learn, self.most = cut, learn, most
        self.codes, self.ids, self.n_ids = _Codes(), np.zeros(1 << 12, np.uint32), 0
        self.first, self.size, self.used = (np.zeros(1 << 10, np.int64) for _ in range(3))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut(t) for t in texts]
        bounds = np.cumsum([0, *map(len, cut)])
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(cut)), np.int64, int(bounds[-1]))
        if self.codes.new:
            self._learn()
        np.add.at(self.used, codes, 1)
        size = self.size[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.first[codes] - ends[:-1], size) + np.arange(ends[-1])].astype("<u4", copy=False).tobytes()
        ends = (4 * ends[bounds]).tolist()
        if len(self.codes) > self.most:
            self._forget()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def _learn(self) -> None:
        """Learn the new pieces; a word with punctuation after its last letter is put together from the two."""
        whole, joined = [], {}
        for piece in self.codes.new:
            word = piece.rstrip(string.punctuation)
            if len(word) == len(piece) or word[-1:] not in _PLAIN or "<|" in piece:
                whole.append(piece)
            else:
                joined[piece] = (word, piece[len(word) :])
        parts = {x for pair in joined.values() for x in pair}.difference(whole)
        known, asked = {x: self._known(self.codes[x]) for x in parts if x in self.codes}, [x for x in parts if x not in self.codes]
        for x in asked:
            self.codes[x]  # noqa: B018 - gives it a number
        got = known | dict(zip(whole + asked, self.learn(whole + asked), strict=True))
        self._store([got[joined[x][0]] + got[joined[x][1]] if x in joined else got[x] for x in self.codes.new])
        self.codes.new = []

    def _known(self, code: int) -> bytes:
        return self.ids[self.first[code] : self.first[code] + self.size[code]].astype("<u4", copy=False).tobytes()

    def _store(self, found: list[bytes]) -> None:
        """Add the ids of the last pieces numbered."""
        more, n, at = np.frombuffer(b"".join(found), "<u4"), len(self.codes), len(self.codes) - len(found)
        if n > len(self.first):
            self.first, self.size, self.used = (np.concatenate([x[:at], np.zeros(2 * n - at, np.int64)]) for x in (self.first, self.size, self.used))
        if self.n_ids + len(more) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.n_ids], np.zeros(self.n_ids + 2 * len(more), np.uint32)])
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        self.size[at:n], self.first[at:n], self.used[at:n] = size, self.n_ids + np.cumsum(size) - size, 0
        self.ids[self.n_ids : self.n_ids + len(more)] = more
        self.n_ids += len(more)

    def _forget(self) -> None:
        pieces, keep = list(self.codes), np.argsort(-self.used[: len(self.codes)], kind="stable")[: self.most // 2]
        first, size = self.first[keep], self.size[keep]
        start = np.cumsum(size) - size
        self.ids = self.ids[np.repeat(first - start, size) + np.arange(size.sum())]
        self.codes, self.n_ids = _Codes(map(pieces.__getitem__, keep.tolist())), len(self.ids)
        self.first[: len(keep)], self.size[: len(keep)], self.used[: len(keep)] = start, size, (self.used[keep] + 1) // 2


def words_as_bytes(ids: list[int]) -> bytes:
    """``ids`` as little-endian unsigned 32-bit integers."""
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves, the others follow from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def library_learner(path: str) -> Callable[[list[str]], list[bytes]]:
    """``learn`` by the tokenizers library, without special tokens, truncation and padding.

    A plain Latin word, with the space before it where spaces are kept, is one pre-token: the file's
    model gets it at once. All other pieces go through the whole tokenizer.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    setting, model = settings(path), tokenizer.model
    quick = '"ByteLevel"' in setting["pre_tokenizer"] and '"add_prefix_space": true' not in setting["pre_tokenizer"]
    lowers, keeps = lowers_case(path), not drops_space(path)
    letters = str.maketrans(dict(enumerate(byte_letters())))

    def learn(pieces: list[str]) -> list[bytes]:
        out, rest = [], []
        for i, piece in enumerate(pieces):
            word = piece[1:] if keeps and piece[:1] == " " else piece
            if quick and word and _LATIN.issuperset(word):
                written = (piece.lower() if lowers else piece).encode().decode("latin-1").translate(letters)
                out.append(words_as_bytes([t.id for t in model.tokenize(written)]))
            else:
                rest.append(i)
                out.append(b"")
        for i, found in zip(rest, tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = words_as_bytes(found.ids)
        return out

    return learn


@lru_cache(maxsize=8)
def settings(path: str) -> dict[str, str]:
    """The file's normalizer and pre-tokenizer, as JSON."""
    with open(path) as f:
        whole = json.load(f)
    return {name: json.dumps(whole.get(name)) for name in ("normalizer", "pre_tokenizer")}


def drops_space(path: str) -> bool:
    """Whether the file's pre-tokenizer removes white space."""
    return '"Removed"' in settings(path)["pre_tokenizer"]


def lowers_case(path: str) -> bool:
    return '"Lowercase"' in settings(path)["normalizer"]


def lower_pieces_of(text: str) -> list[str]:
    """The bare pieces for vocabularies in lower case; texts of simple letters are lowered at once."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return bare_pieces_of(text)
    return bare_pieces_of(text.lower())


#: Fixed value: the public byte-level pre-token pattern (public_tokenizers.PATTERN).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class WholeTexts:
    """Texts to ids for plain byte-level files, where merges go by the ids of their products: the vocabulary
    as ranks, whole texts at once. Texts with the string of an added token, and very long ones, go to ``other``.
    """

    def __init__(self, whole: dict, other: Encoder, longest: int = 1 << 20):
        import tiktoken

        byte_of = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        self.added, self.other, self.longest = [x["content"] for x in whole["added_tokens"]], other, longest
        ranks = {b"".join(map(byte_of.__getitem__, s)): i for s, i in whole["model"]["vocab"].items() if s not in self.added}
        self.library = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def fits(whole: dict) -> bool:
        model, before = whole["model"], whole["pre_tokenizer"] or {}
        plain = not whole["normalizer"] and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        bare = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not (plain and bare):
            return False
        products = [model["vocab"]["".join(pair.split(" ") if isinstance(pair, str) else pair)] for pair in model["merges"]]
        return all(a < b for a, b in zip([255, *products], products)) and {model["vocab"].get(c) for c in byte_letters()} == set(range(256)) and len(products) + 256 + len(whole["added_tokens"]) >= len(model["vocab"])

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [None if len(t) > self.longest or any(x in t for x in self.added) else self._ids(t) for t in texts]
        rest = iter(self.other.encode([t for t, ids in zip(texts, out, strict=True) if ids is None]))
        return [next(rest) if ids is None else ids for ids in out]

    def _ids(self, text: str) -> bytes:
        return self.library.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder | WholeTexts:
    """The worker's encoder for a tokenizer file."""
    cut = pieces_of if not drops_space(path) else lower_pieces_of if lowers_case(path) else bare_pieces_of
    words = Encoder(cut, library_learner(path))
    with open(path) as f:
        whole = json.load(f)
    return WholeTexts(whole, words) if WholeTexts.fits(whole) else words
