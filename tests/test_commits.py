"""Commit files, the registry and run records under writers that run at the same time."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from cohorta.sources import commits
from cohorta.sources.registry import ModelRegistry


def at_once(job, count):
    with ThreadPoolExecutor(count) as pool:
        return list(pool.map(job, range(count)))


def test_one_writer_gets_the_name(spark, folder):
    path = f"{folder}/a/b.json"
    assert sorted(at_once(lambda i: commits.create_if_absent(spark, path, f"{i}\n"), 8)) == [False] * 7 + [True]
    assert commits.create_if_absent(spark, f"file://{path}", "again") is False
    with open(path, encoding="utf-8") as handle:
        assert len(handle.read().split()) == 1


def test_registrations_at_once_get_numbers_without_a_gap(spark, folder):
    store = f"{folder}/store"
    numbers = at_once(lambda i: ModelRegistry(spark, store).register("m", f"r{i}", "churn", 0.5, f"/p{i}", {"f1": i}), 6)
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    registry = ModelRegistry(spark, store)
    assert {r["model_version"]: r["run_id"] for r in registry.versions().collect()} == {n: f"r{i}" for i, n in enumerate(numbers)}
    assert registry.metrics().count() == 6
    assert registry.register("other/model", "x", "churn", 0.5, "/p") == 1


def test_promotions_at_once_leave_one_chain(spark, folder):
    """Every champion but the last became the former one of the next commit."""
    registry = ModelRegistry(spark, f"{folder}/store")
    for i in range(4):
        registry.register("m", f"r{i}", "churn", 0.5, "/p")
    at_once(lambda i: ModelRegistry(spark, f"{folder}/store").promote("m", i + 1, True), 4)
    commits_by_number = {}
    for r in registry.alias_history().collect():
        commits_by_number.setdefault(r["assigned_at"], {})[r["alias"]] = r["model_version"]
    assert sorted(commits_by_number) == [1, 2, 3, 4]
    for number in (2, 3, 4):
        assert commits_by_number[number]["former_champion"] == commits_by_number[number - 1]["champion"]
    assert registry.version_of("m", "champion") == commits_by_number[4]["champion"]


def test_abandoned_claims_are_passed_over(spark, folder, monkeypatch):
    monkeypatch.setattr(commits, "PATIENCE", 2)
    monkeypatch.setattr(commits, "PAUSE", 0.0)
    registry = ModelRegistry(spark, f"{folder}/store")
    registry.set_alias("m", "a", 1)
    assert commits.create_if_absent(spark, f"{folder}/store/aliases/{2:012d}.json", "")
    registry.set_alias("m", "a", 2)
    assert registry.version_of("m", "a") == 2
    assert max(r["assigned_at"] for r in registry.alias_history().collect()) == 3


def test_other_errors_are_raised(spark, folder):
    with open(f"{folder}/file", "w", encoding="utf-8") as handle:
        handle.write("x")
    with pytest.raises(OSError):
        commits.create_if_absent(spark, f"{folder}/file/below.json", "x")
