"""What a Python worker keeps after a task, in a process of its own."""

import os
import subprocess
import sys

import pytest

LEFT_AFTER = """
import random, re
import numpy as np, pandas as pd, pyarrow as pa
from tradewind.llm import ngram_join, suffix_dedup

def used():
    found = open("/proc/self/smaps_rollup").read()
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", found).group(1)) / 1024

rng = random.Random(1)
words = [f"word{k}" for k in range(5000)]
def batches():
    for k in range(4):
        texts = [" ".join(rng.choices(words, k=400)) for _ in range(5000)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])

before = used()
n = sum(out.num_rows for out in RUN(batches()))
assert n
print(used() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="reads Linux's figures")
@pytest.mark.parametrize("run", ["ngram_join._sign", "suffix_dedup._anchor_rows"])
def test_worker_gives_memory_back_after_a_task(run):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {"PYTHONPATH": repo, "OMP_NUM_THREADS": "1"}
    code = LEFT_AFTER.replace("RUN", run)
    said = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True)
    assert float(said.stdout) < 50
