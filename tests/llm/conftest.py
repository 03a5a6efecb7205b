import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def texts():
    """Rows with null and repeated ids, null, empty, short and repeated texts, upper case, odd white space and one long text."""
    rng = random.Random(7)

    def text(n):
        return rng.choice([" ", "  ", "\n", "\t", "\x0b"]).join(rng.choice(["a", "b", "C", "é", "ß9", "x.y", "　", "\x00"]) for _ in range(n))

    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 20, 100]), rng.choice([None, "", " \n", text(rng.randint(1, 3)), text(rng.randint(3, 40))])) for _ in range(90)]
    long = text(20000)
    return rows + [(7, long), (8, long), (8, long), (9, text(12) + " " + long)]
