"""Listings: pattern tiers, pushed filters, folders that are never opened."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, Not, StringStartsWith

from tidemark.sources import folders


def tree(root):
    for day in ("20240101", "20240102", "20240103", "other"):
        for kind in ("snd", "img"):
            (root / day / kind).mkdir(parents=True)
            for n in ("a.nc", "b.nc", "b.txt"):
                (root / day / kind / n).write_text(day + n)
                os.utime(root / day / kind / n, (1_704_067_200 + 86_400 * int(n == "a.nc"),) * 2)
    (root / "20240101" / "snd" / "empty.nc").write_text("")
    return str(root)


def test_tiers_names_and_filters(spark, tmp_path):
    root = tree(tmp_path)
    found = folders.listed(spark, [f"{root}/^\\d{{8}}$/^(snd|img)$"], r".*\.nc$")
    assert found.count() == 13
    assert {r.tier_0 for r in found.collect()} == {"20240101", "20240102", "20240103"}
    kept = found.filter("tier_0 > '20240101' AND tier_1 = 'snd' AND name LIKE 'a%' AND length + 0 > 3")
    assert sorted(r.path for r in kept.collect()) == [f"{root}/2024010{d}/snd/a.nc" for d in (2, 3)]
    newer = found.filter(F.col("modified") > F.lit("2024-01-01 12:00:00").cast("timestamp"))
    assert {r.name for r in newer.collect()} == {"a.nc", "empty.nc"}
    assert found.filter("length > 0 AND tier_0 IN ('20240101')").count() == 4
    assert found.filter("NOT (tier_1 = 'snd')").count() == 6
    two = folders.listed(spark, [f"{root}/20240102/img", f"file://{root}/^other$/snd", f"{root}/none"])
    assert sorted((r.dir_pos, r.name) for r in two.collect()) == [(0, "a.nc"), (0, "b.nc"), (0, "b.txt"), (1, "a.nc"), (1, "b.nc"), (1, "b.txt")]


def test_filters_reach_the_source(spark, tmp_path):
    root = tree(tmp_path)
    plan = folders.listed(spark, [f"{root}/^.*$/snd"]).filter("tier_0 = '20240102'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan.replace("PushedFilters", "")  # Spark has nothing left to test


def test_excluded_folders_are_never_opened(tmp_path, monkeypatch):
    root, opened = tree(tmp_path), []
    reader = folders.FolderReader({"path": f"{root}/^.*$/^.*$"})
    plain = folders.FolderReader.subfolders
    monkeypatch.setattr(folders.FolderReader, "subfolders", lambda self, folder: opened.append(folder) or plain(self, folder))
    left = list(reader.pushFilters([In(("tier_0",), ("20240102", "other")), StringStartsWith(("tier_1",), "s"), GreaterThan(("a", "b"), 1), Not(EqualTo(("name",), "a.nc"))]))
    assert left == [GreaterThan(("a", "b"), 1)]
    (part,) = reader.partitions()
    assert [x[0] for x in part.value] == [f"{root}/20240102/snd", f"{root}/other/snd"]
    assert opened == [root, f"{root}/20240102", f"{root}/other"]
    rows = [r for batch in reader.read(part) for r in batch.to_pylist()]
    assert [r["name"] for r in rows] == ["b.nc", "b.txt"] * 2
    assert rows[0]["modified"] == dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
