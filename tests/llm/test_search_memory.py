from __future__ import annotations

import os
import subprocess
import sys
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from lossmill.llm.ranked_search import build_index, search

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CHILD = """
import random, re
import pyarrow as pa
from lossmill.llm import ranked_search
from lossmill.llm.common import give_back


def status(name):
    return int(re.search(name + r":\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024


def tables():
    rng = random.Random(1)
    for at in range(8):
        texts = [" ".join(f"{rng.getrandbits(18):x}" for _ in range(300)) for _ in range(500)]
        ids, texts = pa.array(range(at * 500, at * 500 + 500)), pa.array(texts, pa.binary())
        yield pa.RecordBatch.from_arrays([ids, texts], ["id", "text"])


def peak(work):
    give_back()
    open("/proc/self/clear_refs", "w").write("5")
    before = status("VmRSS")
    kept = work()
    high, after = status("VmHWM") - before, status("VmRSS")
    give_back()
    return kept, high, after - status("VmRSS")


class Shared:
    pass


tables = list(tables())
asked = tables[0]["text"][0].as_py().split()[:10]
Shared.value = [(0, asked, ranked_search.np.arange(1, 11))]
blocks, *build = peak(lambda: list(ranked_search._blocks(4000, 1_200_000, 1 << 20)(tables)))
assert len(blocks) == 2 and blocks[0].num_rows == 1
found, *searched = peak(lambda: list(ranked_search._searcher(Shared, 10)(blocks)))
assert found[0].num_rows == 10
print(*build, *searched)
"""


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_worker_needs_little_memory_for_a_block_and_returns_it():
    """MB above the start for a whole block, and what is kept at the end of a task."""
    run = subprocess.run(
        [sys.executable, "-c", CHILD], cwd=ROOT, capture_output=True, text=True, timeout=300
    )
    assert run.returncode == 0, run.stderr
    build, kept, searched, kept_of_search = map(float, run.stdout.split())
    assert build < 160 and searched < 140
    assert kept < 12 and kept_of_search < 12


def test_a_row_group_of_the_index_is_one_block(spark):
    """A reader holds a row group at least, whatever the size of its split."""
    docs = [(k, " ".join(f"w{(k * 7 + j) % 90}" for j in range(20))) for k in range(300)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    index = build_index(docs, cells=200)
    n_blocks = index.blocks.count()
    groups = []
    for name in index.blocks.inputFiles():
        about = pq.ParquetFile(urlparse(name).path).metadata
        groups += [about.row_group(k).num_rows for k in range(about.num_row_groups)]
    assert groups == [1] * n_blocks and n_blocks >= 30
    items = spark.createDataFrame([(0, "w3 w8")], "item_id long, text string")
    assert search(index, items, k=5).count() == 5
