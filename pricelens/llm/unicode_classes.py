"""Letters, digits and white space as the tokenizer libraries' regex engines class them.

Python's own tables and those of the ``regex`` module are of other Unicode versions.  Where the two
disagree, or a code point is unassigned in one of them, the installed ``tokenizers`` library is asked.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

OTHER, LETTER, DIGIT, SPACE = range(4)
#: A code point of each class on which all engines agree.
STAND_IN = {OTHER: "\ue000", LETTER: "a", DIGIT: "0", SPACE: " "}
_SIZE = 0x110000


def _matched(pattern: str) -> np.ndarray:
    """Code points that ``regex`` matches."""
    import regex

    out = np.zeros(_SIZE, bool)
    points = np.r_[0:0xD800, 0xE000:_SIZE].astype("<u4")
    text = points.tobytes().decode("utf-32-le")
    for m in regex.finditer(pattern + "+", text):
        out[points[m.start():m.end()]] = True
    return out


@lru_cache(maxsize=1)
def code_point_classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of every code point, and the classes by ``regex``."""
    from tokenizers import Regex, pre_tokenizers

    own = np.zeros(_SIZE, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", SPACE)):
        own[_matched(pattern)] = kind
    python = np.fromiter(({"L": LETTER, "N": DIGIT}.get(unicodedata.category(chr(c))[0], OTHER) for c in range(_SIZE)), np.uint8, _SIZE)
    out = own.copy()
    doubt = np.flatnonzero((python != own) & (own != SPACE) & ~((np.arange(_SIZE) >= 0xD800) & (np.arange(_SIZE) < 0xE000)))
    text = " ".join(map(chr, doubt.tolist()))
    out[doubt] = OTHER
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT)):
        split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        places = [a // 2 for _, (a, _) in split.pre_tokenize_str(text)]
        out[doubt[places]] = kind
    return out, own


def _one_of(points: np.ndarray) -> re.Pattern:
    """A pattern that finds any of the (rising) code points."""
    ranges = [(int(r[0]), int(r[-1])) for r in np.split(points, np.flatnonzero(np.diff(points) > 1) + 1) if len(r)]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]" if ranges else r"(?!)")


@lru_cache(maxsize=1)
def regex_stand_ins() -> tuple[re.Pattern, dict[int, str]]:
    """Finds code points that ``regex`` classes otherwise, and the stand-in of each, one for one."""
    right, own = code_point_classes()
    wrong = np.flatnonzero(right != own)
    return _one_of(wrong), {int(c): STAND_IN[int(right[c])] for c in wrong}


@lru_cache(maxsize=1)
def young_code_points() -> re.Pattern:
    """Finds code points that Unicode 3.2 did not have; of older ones all tables know the same case and composition."""
    old = unicodedata.ucd_3_2_0
    return _one_of(np.flatnonzero(np.fromiter((old.category(chr(c)) == "Cn" for c in range(_SIZE)), bool, _SIZE)))


def is_latin(text: str) -> bool:
    """Whether all code points are below 256, where all tables agree; much cheaper than a pattern."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True
