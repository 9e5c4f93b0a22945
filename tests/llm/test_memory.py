"""Python workers hand back what a block's work freed."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import numpy as np
import pytest

from marquee.llm import common


def resident() -> int:
    return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) * 1024


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_freed_memory_goes_back_where_work_begins():
    held = [np.full(1000, k, np.uint64) for k in range(20_000)]  # 160 MB in small pieces
    last = held.pop()  # keeps the heap's end in use
    full = resident()
    held.clear()
    common.begin()
    assert full - resident() > 100_000_000
    assert last[0] == 19_999
