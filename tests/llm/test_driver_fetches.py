"""Every place of the subpackage where rows reach the driver, and its bound."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

PKG = Path(__file__).resolve().parents[2] / "partnerwatch" / "llm"
FETCH = re.compile(r"(?<!\bF)\.(collect|toPandas|take|first|toArrow|toLocalIterator|localCheckpoint)\(")
#: (module, call): how often, and what bounds the rows.
BOUNDED = {
    ("components.py", "first"): (1, "one row: a count and a checksum"),
    ("decontaminate.py", "first"): (1, "one row: characters of the items"),
    ("decontaminate.py", "toLocalIterator"): (1, "the items of one block of at most BLOCK_CHARS characters"),
    ("jaccard_join.py", "take"): (2, "one row: whether pairs are left"),
    ("jaccard_join.py", "toArrow"): (1, "COUNTS numbers"),
    ("mixing.py", "first"): (2, "one row of sums a round"),
    ("packing.py", "collect"): (1, "a count for each length up to the capacity"),
    ("quality.py", "toArrow"): (1, "d x d moments a class"),
    ("topk.py", "first"): (1, "one row: the largest dimension"),
    ("topk.py", "toArrow"): (2, "d x d moments; HEAD vectors"),
    ("topk.py", "collect"): (1, "one number a block of 4096 vectors"),
    ("toxicity.py", "collect"): (1, "a count for each part and label"),
    ("toxicity.py", "first"): (1, "one row of sums"),
    ("toxicity.py", "toArrow"): (3, "buckets of the lexicon; a count for each of its scores; two numbers for each document of the bounded sample"),
}


def test_driver_fetches_are_the_listed_ones():
    found = Counter((f.name, call) for f in PKG.glob("*.py") for call in FETCH.findall(f.read_text()))
    found = {k: n for k, n in found.items() if (PKG / k[0]).exists()}
    listed = {k: n for k, (n, _) in BOUNDED.items() if (PKG / k[0]).exists()}
    assert found == listed
