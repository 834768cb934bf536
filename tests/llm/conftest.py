import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture
def texts():
    """Texts with nulls, blanks, repeats inside and across, near copies, odd characters, and a long one."""
    import random

    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdeéö") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared, base = prose(60), prose(120)
    edited = base.split()
    edited[40] = "changed"
    return [
        None, "", "  \t\n\x0b ", "one", "two words", "two  words", "a b c d", prose(34), prose(35), base, base, base.replace(" ", "\n"),
        " ".join(edited), prose(50) + " " + shared + " " + prose(20), shared + "\n" + prose(40), "x " * 200, prose(30) + " " + prose(10) * 3,
        "same line\n" * 5 + "other\n\n\n", "### | $$ <b> %", " non breaking \U0001f600 emoji\x85next", prose(6000), "w" * 100_000 + " end", prose(80),
    ]
