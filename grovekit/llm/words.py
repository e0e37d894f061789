"""Word splitting and hashing on UTF-8 bytes, shared by the operators on words.

Everything works on whole texts. Case folding touches A-Z only, as both word rules ask.
"""

from hashlib import blake2b

import numpy as np

#: Bytes that end an alphanumeric word become spaces, A-Z become a-z, bytes of non-ASCII characters stay.
_ALNUM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_CACHE_WORDS = 400_000


def alnum_words(text):
    """Words of digits, a-z and non-ASCII characters, as bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_ALNUM).split() if text else []


def space_words(text):
    """Words between ASCII white space, A-Z lower-cased, as bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHasher:
    """64-bit hashes of words; remembers a bounded number of them between texts."""

    def __init__(self, salt=b""):
        self._salt, self._known = salt, {}

    def __call__(self, words):
        known = self._known
        if len(known) > _CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = int.from_bytes(blake2b(w, digest_size=8, key=self._salt).digest(), "little")
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(values):
    """Bit mixing of 64-bit integers, so that sums of products spread over all bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def shingle_hashes(hashes, size):
    """Hash of every run of ``size`` words, in order; none when there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):  # polynomial in an odd base, so the order of words counts
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n]
    return mixed(total)


def shingle_set(hashes, size):
    """Distinct shingle hashes, sorted; the whole sequence as one when it is shorter."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(hashes, min(size, len(hashes))))
