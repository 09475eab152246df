from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CHILD = """
import ctypes, gc, random, re
import pyarrow as pa
import public_tokenizers
from lossmill.llm import packing, suffix_dedup


def held():
    found = re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())
    return sum(map(int, found)) / 1024


def texts(n):
    rng = random.Random(n)
    for k in range(n):
        yield "".join(rng.choices("abcdefgh ", k=12_000))


def tables():
    for at in range(2):
        some = pa.array(list(texts(400 + at)))
        n = pa.array([at] * len(some), pa.int64())
        yield pa.RecordBatch.from_arrays([n, some, n], ["id", "text", "part"])


def coded():
    for t in tables():
        data = t.column(1).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([t.column(0), data], ["row", "text"])


path = public_tokenizers.path("word_bpe_49k.json")
work = {
    "packing": lambda: packing._encode(path, 2048, 1)(tables()),
    "samples": lambda: suffix_dedup._cut(204)(coded()),
}
for _ in work[NAME]():
    pass
del _
after = held()
gc.collect()
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
print(after - held())
"""


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
@pytest.mark.parametrize("name", ["packing", "samples"])
def test_a_worker_keeps_no_freed_memory_after_a_task(name):
    """What a trim by hand still finds when a task's function has ended, in MB."""
    code = f"NAME = {name!r}\n{CHILD}"
    run = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300
    )
    assert run.returncode == 0, run.stderr
    assert float(run.stdout) < 12
