"""Statistics of documents: counts over bytes, words, lines and windows of words, a chunk at a time."""

from __future__ import annotations

import numpy as np

from kerbside.llm.common import ragged, word_ids

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

#: Per class, 1 for the bytes that belong to it.
_CLASSES = {
    "code_points": [b < 0x80 or b >= 0xC0 for b in range(256)],
    "word_chars": [(b < 0x80 or b >= 0xC0) and b not in WHITE for b in range(256)],
    "symbols": [b in SYMBOLS for b in range(256)],
    "upper": [0x41 <= b <= 0x5A for b in range(256)],
    "letters": [0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0xC0 for b in range(256)],
    "digits": [0x30 <= b <= 0x39 for b in range(256)],
    "wide": [b >= 0xC0 for b in range(256)],
    "stops": [b in b".,;:" for b in range(256)],
    "marks": [b in b"!?" for b in range(256)],
    "pipes": [b in b"|" for b in range(256)],
    "markup": [b in b"<>{}[]()=/\\_~^@" for b in range(256)],
    "control": [b < 0x20 and b not in WHITE for b in range(256)],
    "breaks": [b == 0x0A for b in range(256)],
}
CLASS_NAMES = list(_CLASSES)
_MATRIX = np.array(list(_CLASSES.values()), np.float64).T


def class_counts(texts: list[bytes]) -> np.ndarray:
    """One row per text, one column per class of bytes."""
    counts = np.zeros((len(texts), 256))
    for i, text in enumerate(texts):
        counts[i] = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return counts @ _MATRIX


def _numbered(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal pairs get equal numbers; exact, nothing is hashed."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def repeated_words(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text, the words that stand in an 8-word window found twice or more in that text."""
    out = np.zeros(len(sizes), np.int64)
    n = len(ids) - 7
    if n <= 0:
        return out
    two = _numbered(ids[:-1], ids[1:])
    four = _numbered(two[:-2], two[2:])
    eight = _numbered(four[:-4], four[4:])
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    valid = ragged(starts, np.maximum(sizes - 7, 0))
    _, inverse, counts = np.unique(owner[valid] * n + eight[valid], return_inverse=True, return_counts=True)
    at = valid[counts[inverse] > 1]
    edges = np.bincount(at, minlength=len(ids) + 1) - np.bincount(at + 8, minlength=len(ids) + 9)[: len(ids) + 1]
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(sizes)).astype(np.int64)


def line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of each text; words are what white space separates."""
    words = [text.split() for text in texts]
    ids, sizes = word_ids(words)
    owner = np.repeat(np.arange(len(texts)), sizes)
    per_word, times = np.unique(owner * (int(ids.max(initial=0)) + 1) + ids, return_counts=True)
    word_owner = per_word // (int(ids.max(initial=0)) + 1)
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, word_owner, times)
    lengths = np.fromiter((len(w) for ws in words for w in ws), np.int64, len(ids))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, owner, lengths)
    lines = np.array([line_counts(t) for t in texts], np.int64).reshape(-1, 2)
    classes = class_counts(texts)
    return {
        **{name: classes[:, i] for i, name in enumerate(CLASS_NAMES)},
        "bytes": np.fromiter(map(len, texts), np.int64, len(texts)),
        "words": sizes,
        "distinct_words": np.bincount(word_owner, minlength=len(texts)),
        "most_frequent": most,
        "longest_word": longest,
        "lines": lines[:, 0],
        "dup_lines": lines[:, 1],
        "repeat_words": repeated_words(ids, sizes),
    }


#: name: (feature, direction in which the score may move as it grows; 0: either).
FEATURES = {
    "log_bytes": (lambda s: np.log1p(s["bytes"]), 0),
    "log_words": (lambda s: np.log1p(s["words"]), 0),
    "word_length": (lambda s: s["word_chars"] / np.maximum(s["words"], 1), 0),
    "log_longest": (lambda s: np.log1p(s["longest_word"]), 0),
    "symbols_a_word": (lambda s: s["symbols"] / np.maximum(s["words"], 1), -1),
    "marks_a_word": (lambda s: s["marks"] / np.maximum(s["words"], 1), -1),
    "pipes_a_word": (lambda s: s["pipes"] / np.maximum(s["words"], 1), -1),
    "markup_a_word": (lambda s: s["markup"] / np.maximum(s["words"], 1), -1),
    "upper_share": (lambda s: s["upper"] / np.maximum(s["letters"], 1), -1),
    "letter_share": (lambda s: s["letters"] / np.maximum(s["word_chars"], 1), 0),
    "digit_share": (lambda s: s["digits"] / np.maximum(s["word_chars"], 1), 0),
    "wide_share": (lambda s: s["wide"] / np.maximum(s["code_points"], 1), 0),
    "stops_a_word": (lambda s: s["stops"] / np.maximum(s["words"], 1), 0),
    "control_share": (lambda s: s["control"] / np.maximum(s["code_points"], 1), -1),
    "line_length": (lambda s: np.log1p(s["words"] / np.maximum(s["lines"], 1)), 0),
    "breaks_a_word": (lambda s: s["breaks"] / np.maximum(s["words"], 1), 0),
    "dup_line_share": (lambda s: s["dup_lines"] / np.maximum(s["lines"], 1), -1),
    "repeat_share": (lambda s: s["repeat_words"] / np.maximum(s["words"], 1), -1),
    "distinct_share": (lambda s: s["distinct_words"] / np.maximum(s["words"], 1), 0),
    "frequent_share": (lambda s: s["most_frequent"] / np.maximum(s["words"], 1), 0),
}
DIRECTIONS = [direction for _, direction in FEATURES.values()]


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.column_stack([np.asarray(make(stats), np.float64) for make, _ in FEATURES.values()])
