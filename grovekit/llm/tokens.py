"""Token ids by a public byte-level tokenizer, with a memory of the pieces that recur.

The tokenizer splits a text at every boundary between a word and a single space or line
break before any merging, and between letters and the marks that follow them. Such pieces
are encoded once and joined. A text that holds the string of an added token, which the
tokenizer takes out before it splits, goes to it whole.
"""

import os
import re
from array import array
from functools import lru_cache

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
_KNOWN_PIECES = 300_000
_KNOWN_WORDS = 700_000
_TEXTS_AT_ONCE = 64
_TWO_SPACES = re.compile(r"\s\s")
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
_MARKS = ".,;:!?%*#$&|"


def default_path():
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _byte_letters():
    """Letters that byte-level vocabularies write for the bytes: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids; an empty or null text has none."""

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._model, self._letters = self._tokenizer.model, _byte_letters()
        self._space = self._letters[0x20]
        self._first, self._later, self._words = {}, {}, {}

    def _word(self, text):
        """Ids of letters that follow a space; no pre-tokenizer has anything to split in them."""
        ids = self._words.get(text)
        if ids is None:
            if len(self._words) > _KNOWN_WORDS:
                self._words.clear()
            letters = self._space + (text if text.isascii() else text.encode().decode("latin-1").translate(self._letters))
            ids = array("I", [t.id for t in self._model.tokenize(letters)]).tobytes()
            self._words[text] = ids
        return ids

    def _other(self, pieces):
        if not pieces:
            return []
        encoded = self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _learn_first(self, pieces):
        if len(self._first) > _KNOWN_PIECES:
            self._first.clear()
        new = list(set(pieces).difference(self._first))
        self._first.update(zip(new, self._other(new)))

    def _learn_later(self, pieces):
        known = self._later
        if len(known) > _KNOWN_PIECES:
            known.clear()
        other = []
        for piece in pieces.difference(known):
            word = piece.rstrip(_MARKS)
            if word.isalpha():
                marks = piece[len(word):]
                if marks not in self._first:
                    self._learn_first([marks])
                known[piece] = self._word(word) + self._first[marks]
            else:
                other.append(piece)
        # A piece that starts with a line break follows it directly; others follow a space.
        known.update(zip(other, self._other([p if p[:1] == "\n" else " " + p for p in other])))

    def __call__(self, texts):
        """Ids of each text as bytes, in order."""
        out = []
        for i in range(0, len(texts), _TEXTS_AT_ONCE):
            split = []
            for text in texts[i:i + _TEXTS_AT_ONCE]:
                if not text:
                    split.append(("", []))
                    continue
                if any(t in text for t in self._added):
                    split.append((text, None))
                    continue
                # Single spaces and line breaks only: every one of them starts a piece.
                pieces = (_BETWEEN_WORDS.split(text) if _TWO_SPACES.search(text)
                          else text.replace("\n", " \n").split(" "))
                split.append((pieces[0], pieces[1:]))
            self._learn_first([a for a, rest in split if rest is not None])
            self._learn_later({p for _, rest in split if rest for p in rest})
            first, later = self._first, self._later
            out += [self._other([a])[0] if rest is None else first[a] + b"".join([later[p] for p in rest]) for a, rest in split]
        return out


@lru_cache(maxsize=2)
def encoder(path):
    """One encoder a process, so that what it has learned serves all tasks of a worker."""
    return Encoder(path)
