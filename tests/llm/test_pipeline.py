"""The pipeline's stages one by one against their operators, and the registry without them."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest

from faultline.llm import packing, pii, queries
from faultline.llm.common import materialise
from tests.llm.test_simhash import plain_fingerprint

ROOT = Path(corpus_pipeline.__file__).resolve().parent


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    folder = sf_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, folder), f"test-{name}")
        out.append((name, docs))
    return dict(out)


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_come_in_order_and_keep_the_columns(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "personal_values", "packing"]
    columns = results["documents"].dtypes
    assert all(df.dtypes == columns for name, df in results.items() if name != "packing")


def test_filters_agree_with_the_labels(spark, sf_dir, results):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    start, good, clean = (rows(results[n]) for n in ("documents", "quality", "toxicity"))
    assert set(clean) <= set(good) <= set(start)
    known = [d for d in start if d in labels]
    assert sum((d in good) == bool(labels[d]["quality"]) for d in known) >= 0.95 * len(known)
    known = [d for d in good if d in labels]
    assert sum((d not in clean) == bool(labels[d]["toxic"]) for d in known) >= 0.95 * len(known)
    assert all(good[d] == start[d] for d in good)


def test_one_of_each_group_stays(results):
    before, after = rows(results["toxicity"]), rows(results["near_duplicates"])
    ids = sorted(before)
    prints = np.array([plain_fingerprint(before[d]["text"]) for d in ids], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= corpus_pipeline.RADIUS
    first = np.arange(len(ids))
    while True:  # the smallest position reachable
        lower = np.where(near, first[None, :], len(ids)).min(axis=1)
        if (lower == first).all():
            break
        first = lower
    assert set(after) == {ids[i] for i in set(first.tolist())}


def test_values_are_replaced_in_all_that_is_kept(results):
    before, after = rows(results["near_duplicates"]), rows(results["personal_values"])
    made = pii.Pseudonyms(queries.PSEUDONYM_KEY)
    assert {d: r["text"] for d, r in after.items()} == {d: made.replace(r["text"])[0] for d, r in before.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_every_kept_text_is_packed_once(results):
    kept = rows(results["personal_values"])
    with open(queries.tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokens = packing.Tokens(f.read(), 0)
    sizes = Counter()
    for r in results["packing"].collect():
        sizes[r["doc_id"]] += r["length"]
    assert sizes == {d: len(tokens.encode(r["text"])) // 4 for d, r in kept.items()}


def test_run_gives_the_last_stage(spark, sf_dir, results):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == results["packing"].columns
    assert {r["doc_id"] for r in found.select("doc_id").collect()} == set(rows(results["personal_values"]))


def test_the_registry_works_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "faultline", tmp_path / "faultline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path)
    (tmp_path / "faultline/llm/__pycache__").mkdir(parents=True)  # as a deletion may leave it
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') or k == 'pipeline' for k in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": os.environ["PATH"]})
    assert done.returncode == 0, done.stderr
    count, present = done.stdout.split()
    assert present == "False" and int(count) > 60
