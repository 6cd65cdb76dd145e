import random

import pytest


@pytest.fixture
def prose():
    """Seeded texts of invented words."""

    def make(n, seed=0, words=60):
        r = random.Random(seed)
        parts = ["an", "the", "re", "on", "ti", "er", "sh", "ou", "ble", "ing"]
        return [" ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(words)) for _ in range(n)]

    return make
