"""Regions of the Jaccard join: parted by size, many to a call, and counted within bounded memory."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from shelfmark.llm import jaccard


def test_holders_of_unlike_sizes_are_in_no_region(spark):
    token = np.array([7], np.uint64).tobytes()
    lead = spark.createDataFrame(pd.DataFrame({"key": [5, 6, 8, 9], "n": [100, 125, 157, 1000], "lead": [token] * 4}))
    found = {(r.region, r.key) for r in jaccard.members(lead, 4).collect()}
    assert found == {(5, 5), (5, 6)}  # 100 of 125 may link; 125 of 157 and 157 of 1000 may not


def test_a_chain_of_sizes_stays_whole():
    region, key = jaccard.holders(np.full(4, 3, np.uint64), np.array([40, 30, 20, 10]), np.array([150, 100, 120, 185], np.uint32), 80)
    assert sorted(zip(region.tolist(), key.tolist(), strict=True)) == [(10, 10), (10, 20), (10, 30), (10, 40)]


@pytest.mark.parametrize("similarity", [50, 80])
def test_regions_together_are_solved_as_each_alone(similarity):
    rng = np.random.default_rng(similarity)
    raw, number = [], rng.integers(1, 12, 200)
    for m in number:
        base = [rng.integers(0, 2**63, 60, dtype=np.uint64) for _ in range(2)]
        raw += [jaccard.bucket_counts(np.unique(np.append(base[rng.integers(2)][: rng.integers(40, 60)], rng.integers(0, 2**63, rng.integers(0, 9), dtype=np.uint64)))) for _ in range(m)]
    keys = rng.permutation(10 * len(raw))[: len(raw)].astype(np.int64)
    start = np.cumsum(number) - number
    together = jaccard.solve_few(keys, *jaccard._read_counts(raw), start, number, similarity)
    alone = [jaccard.solve(keys[i : i + m], *jaccard._read_counts(raw[i : i + m]), similarity) for i, m in zip(start, number, strict=True)]
    assert together.tolist() == np.concatenate(alone).tolist()
    assert (together != keys).any()


def test_few_regions_a_call(spark):
    """A call for every region cost more than its work."""
    keys = np.arange(20_000, dtype=np.int64)
    rows = spark.createDataFrame(pd.DataFrame({"region": (keys // 2).astype(str), "key": keys}))
    calls = jaccard.by_region(rows, len(keys), 2000, lambda pdf: pd.DataFrame({"m": [len(pdf)], "whole": [bool((pdf.groupby("region").size() == 2).all())]}), "m long, whole boolean").collect()
    assert sum(r.m for r in calls) == len(keys) and all(r.whole for r in calls)
    assert len(calls) < 10_000 / 100


def test_links_of_a_family_are_counted_in_bounded_memory():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 100, dtype=np.uint64)
    sets = [np.unique(np.append(base, rng.integers(0, 2**63, 5, dtype=np.uint64))) for _ in range(1500)]
    ones = np.ones(len(sets), np.int64)
    tracemalloc.start()
    n = jaccard.link_sums(sets, ones, ones.astype(bool), -ones, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.tolist() == [len(sets) - 1] * len(sets)
    assert peak < 8 * len(sets) ** 2 * 2.5  # before, each step of the test of all pairs made whole squares of 64 bits


def test_sums_of_sketches_stay_small_for_many_tasks():
    """A group that sums sketches holds a blob of each shard, four times as long as a task's."""
    assert jaccard.SHARDS * 4 * jaccard.CELLS // jaccard.SLICES <= 8 << 20
