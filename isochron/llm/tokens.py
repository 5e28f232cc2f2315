"""Encoding whole texts by a tokenizer file inside tasks: the ids are those of the tokenizers library.

Ids are little-endian unsigned 32-bit integers in one bytes value per text. Merging is what costs, and the merge engine of tiktoken does it several times
faster from the same vocabulary; so it is used wherever the result is the same, and the library itself everywhere else:
  * byte-level vocabularies whose pre-tokens may begin with a space: whole texts, cut by the same pattern;
  * vocabularies of lower-case words with word ends, which drop white space: words of letters. Words repeat far more often than texts, so a worker
    keeps the ids of words it has met and joins them per text.
Texts that may hold the string of a special token, words with other signs, and files whose merges do not stand in the order of their ids go to the
library. Tests hold all of it against the library.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from array import array
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers

# White space other than single spaces and line feeds inside the text.
UNEVEN = re.compile(r"[^\S \n]|\s\s|\A\s|\s\Z")
KEPT_WORDS = 800_000
KEPT_LENGTH = 64
ENCODED_AT_ONCE = 20_000
MARKS = ".,;:!?#*$%&|"
# How vocabularies write the end of a word.
WORD_END = "</w>"
# Letters below this one are composed, and their lower case is one letter.
PLAIN_BELOW = "\u0130"


def as_bytes(ids: Sequence[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def cut_before_spaces(text: str) -> list[str] | None:
    """Pieces "first", " word", "\\nword", ...; None where the text cannot be cut."""
    if UNEVEN.search(text):
        return None
    first, *rest = text.replace("\n", " \n").split(" ")
    return [first, *[w if w[0] == "\n" else " " + w for w in rest]] if first or rest else []


def cut_at_spaces(text: str) -> list[str]:
    return [w for w in text.replace("\n", " ").split(" ") if w]


class WordEncoder:
    """Encodes texts by pieces. Pieces are remembered in two generations of half of `kept` each: when the younger is full it becomes the
    older, whose pieces are taken over again as they are met, so that rare ones are forgotten and frequent ones stay."""

    def __init__(
        self, encode: Callable[[list[str]], list[bytes]], cut: Callable[[str], list[str] | None], kept: int = KEPT_WORDS,
        whole: Callable[[list[str]], list[bytes]] | None = None,
    ):
        self.encode, self.cut, self.kept, self.whole = encode, cut, kept, whole or encode
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def learn(self, pieces: list[str]) -> None:
        """Know these pieces. Marks after a letter and a line feed before a word are parts of their own, as no token holds both,
        so words that differ only in them are encoded once."""
        known, older, new, joined = self.known, self.older, set(), []
        for piece in pieces:
            if piece.isalpha():
                new.add(piece)
                continue
            head = piece.rstrip(MARKS)
            if not head[-1:].lower().isalpha():  # the lower case of a letter may end in a sign that joins the marks
                head = piece
            if head[:1] == "\n":
                parts = ("\n", head[1:], piece[len(head):])
            elif len(head) < len(piece):
                parts = (head, piece[len(head):])
            else:
                new.add(piece)
                continue
            joined.append((piece, parts))
            for part in parts:
                if part not in known:
                    if part in older:
                        known[part] = older[part]
                    else:
                        new.add(part)
        todo = list(new)
        for at in range(0, len(todo), ENCODED_AT_ONCE):
            part = todo[at:at + ENCODED_AT_ONCE]
            known.update(zip(part, self.encode(part), strict=True))
        for piece, parts in joined:
            known[piece] = b"".join([known[p] for p in parts])

    def __call__(self, texts: Sequence[str | None]) -> list[bytes]:
        cuts = [self.cut(text or "") for text in texts]
        whole = [text for text, pieces in zip(texts, cuts, strict=True) if pieces is None]
        missing = set(itertools.chain.from_iterable(c for c in cuts if c is not None)).difference(self.known)
        if missing:
            older = self.older
            again = missing.intersection(older)
            self.known.update([(p, older[p]) for p in again])
            self.learn(list(missing - again))
        rest, at = iter(self.whole(whole) if whole else ()), self.known.__getitem__
        done = [next(rest) if c is None else b"".join(map(at, c)) for c in cuts]
        for piece in missing:
            if len(piece) > KEPT_LENGTH:
                self.known.pop(piece, None)
        if len(self.known) > self.kept // 2:
            self.older, self.known = self.known, {"": b""}
        return done


def byte_names() -> dict[int, str]:
    """How byte-level vocabularies write the bytes: printable ones as they are, the others as the characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTES_OF = {name: b for b, name in byte_names().items()}


def in_order(model: dict) -> bool:
    """Whether the tokens made by merges have their ids in the order of the merges, so that an id says which merge comes first."""
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    ids = [model["vocab"]["".join(pair)] for pair in pairs]
    return all(a < b for a, b in itertools.pairwise(ids))


def text_engine(model: dict, pattern: str) -> Callable[[str], bytes]:
    """Ids of a text under a byte-level vocabulary."""
    import tiktoken

    ranks = {bytes(BYTES_OF[c] for c in token): number for token, number in model["vocab"].items() if all(c in BYTES_OF for c in token)}
    engine = tiktoken.Encoding("texts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
    return lambda text: bytes(engine.encode_to_tiktoken_buffer(text, set()))


def word_engine(model: dict) -> Callable[[str], bytes]:
    """Ids of a word of lower-case letters under a vocabulary with word ends. A byte at the end of a word is another symbol than the same byte
    before, so every byte that such letters are written with stands under two numbers."""
    import tiktoken

    used = [*range(ord("a"), ord("z") + 1), *range(0xC2, 0xC5), *range(0x80, 0xC0)]
    inner = {b: number for number, b in enumerate(used)}
    last = {b: len(used) + number for number, b in enumerate(used) if not 0xC2 <= b < 0xC5}
    ranks = {}
    for token, number in model["vocab"].items():
        ended = token.endswith(WORD_END)
        octets = [BYTES_OF.get(c) for c in (token[:-len(WORD_END)] if ended else token)]
        if octets and all(b in inner for b in octets) and (not ended or octets[-1] in last):
            ranks[bytes([inner[b] for b in octets[:-1]] + [(last if ended else inner)[octets[-1]]])] = number
    engine = tiktoken.Encoding("words", pat_str=r"[^\r\n]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    table = bytes(inner.get(b, 0) for b in range(256))
    ends = {b: bytes([number]) for b, number in last.items()}

    def ids(word: str) -> bytes:
        octets = word.encode()
        return array("I", engine.encode_single_piece(octets[:-1].translate(table) + ends[octets[-1]])).tobytes()

    return ids


@lru_cache(maxsize=4)
def file_encoder(path: str, spaces_matter: bool, specials: bool = True) -> Callable[[Sequence[str | None]], list[bytes]]:
    """The encoder of a tokenizer file, one per Python worker. The file must be on every executor.

    The strings of special tokens in a text are those tokens, as the library has it; without `specials` they are ordinary text.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not specials
    heads = sorted({t.content[:2] for t in tokenizer.get_added_tokens_decoder().values()})
    model = json.loads(tokenizer.to_str())["model"]
    fast = in_order(model)

    def whole(texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def special(text: str) -> bool:
        return any(head in text for head in heads)

    if spaces_matter:
        of_text = text_engine(model, public_tokenizers.PATTERN) if fast else None

        def encode_texts(texts: Sequence[str | None]) -> list[bytes]:
            return [of_text(t or "") if fast and not special(t or "") else whole([t or ""])[0] for t in texts]

        return encode_texts

    of_word = word_engine(model) if fast else None

    def encode_words(words: list[str]) -> list[bytes]:
        lower = [w.lower() for w in words]
        known = {w: of_word(x) for w, x in zip(words, lower, strict=True) if fast and x.isalpha() and max(x) < PLAIN_BELOW}
        others = [w for w in words if w not in known]
        if others:
            known.update(zip(others, whole(others), strict=True))
        return [known[w] for w in words]

    return WordEncoder(encode_words, lambda text: None if special(text) else cut_at_spaces(text), whole=whole)
