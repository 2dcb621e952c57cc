"""The log of a run."""

from __future__ import annotations

import logging
from pathlib import Path


def to_file(folder: str | Path, debug: bool = False) -> Path:
    """From now on messages go to a fresh ``curation.log`` in a folder of this machine, with ``debug`` all of them and to
    the console as well; earlier handlers are closed."""
    place = Path(folder)
    place.mkdir(parents=True, exist_ok=True)
    root = logging.getLogger()
    for old in list(root.handlers):
        root.removeHandler(old)
        old.close()
    handlers = [logging.FileHandler(place / "curation.log", mode="w", encoding="utf-8"), *([logging.StreamHandler()] if debug else [])]
    for h in handlers:
        h.setFormatter(logging.Formatter("%(asctime)s | %(levelname)-7s | %(name)s: %(message)s"))
        root.addHandler(h)
    root.setLevel(logging.DEBUG if debug else logging.INFO)
    return place / "curation.log"
