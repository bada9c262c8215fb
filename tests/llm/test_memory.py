"""What a worker needs for very long words and texts, measured in a process of its own."""

from __future__ import annotations

import subprocess
import sys

import numpy as np
import pytest

from tidemark.llm.texts import PIECE, split_words, window_hashes, word_hashes

MEASURE = """
import resource, gc
from tidemark.llm.quality import RULES, LineJudge, judged
from tidemark.llm.texts import split_words, word_hashes
judged([b"a few words " * 9], LineJudge(RULES))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text = {text}
{work}
del text
peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
gc.collect()
now = int(open("/proc/self/statm").read().split()[1]) * 4
print((peak - before) // 1024, (now - before) // 1024)
"""


@pytest.mark.parametrize(
    "text, work, most",
    [
        ("b'x' * (30 << 20)", "word_hashes(split_words([text]))", 350),
        ("b'x' * (30 << 20)", "judged([text], LineJudge(RULES))", 500),
        ("b'some words of a text ' * 850_000", "judged([text], LineJudge(RULES))", 900),
    ],
)
def test_peak_of_long_texts(text, work, most):
    done = subprocess.run([sys.executable, "-c", MEASURE.format(text=text, work=work)], capture_output=True, text=True, check=True)
    peak, kept = map(int, done.stdout.split())
    assert peak < most and kept < 100, (peak, kept)


def test_pieces_do_not_change_hashes():
    """A word and a window have the same hash wherever they lie and however long their surroundings are."""
    long = b"ab" * PIECE + b"c"
    found = word_hashes(split_words([long, b"x", long, b"x " * 5 + long]))
    assert found[0] == found[2] == found[-1] != found[1] and found[1] == found[3]
    numbers = np.arange(3 * PIECE, dtype=np.uint64) % np.uint64(1000)
    every = window_hashes(numbers, 13)
    assert len(every) == 3 * PIECE - 12
    assert (every[:-1000] == every[1000:]).all() and len(np.unique(every)) == 1000
    wide = window_hashes(numbers, PIECE + 1000)
    assert (wide[:1000] == wide[1000:2000]).all() and len(np.unique(wide)) == 1000
