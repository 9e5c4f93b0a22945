"""COVERAGE.md names only things that exist."""

from __future__ import annotations

import os
import re

import marquee.functions as functions
import marquee.operators as operators
import marquee.sources as sources
from marquee.plans import movies, star

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_coverage_names_resolve():
    text = open(os.path.join(REPO, "COVERAGE.md"), encoding="utf-8").read()
    modules = {"movies": movies, "star": star, "operators": operators, "functions": functions, "sources": sources}
    missing = [
        f"{prefix}.{name}"
        for prefix, name in re.findall(r"`(movies|star|operators|functions|sources)\.([a-z_0-9]+)", text)
        if not hasattr(modules[prefix], name)
    ]
    assert not missing, missing
