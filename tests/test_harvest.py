"""Rounds of a harvest: resumed behind the last page, paused together, given up, the next fetcher where one finds nothing."""

import json
import os
from collections import Counter

from foliant.sources import harvest

FETCHERS = '''
import json, os
from foliant.sources.harvest import Busy

HERE = os.path.dirname(os.path.abspath(__file__))

def noted(task, cursor, name):
    with open(os.path.join(HERE, "asked"), "a") as f:
        f.write(json.dumps([name, task["id"], cursor]) + "\\n")

def first(what):
    """True the first time that it is asked."""
    try:
        os.close(os.open(os.path.join(HERE, what), os.O_CREAT | os.O_EXCL))
        return True
    except FileExistsError:
        return False

def paged(task, cursor):
    k, at = task["id"], (cursor or {"at": 0})["at"]
    if k == 9:
        raise ValueError("never")
    if k == 4 and at == 2 and first("killed"):
        raise RuntimeError("killed half-way")
    if k == 6 and at == 1 and first("busy"):
        raise Busy(7.5)
    noted(task, cursor, "paged")
    if k % 2:
        return [], None
    return [json.dumps({"id": k, "n": at})], {"at": at + 1} if at + 1 < k else None

def single(task, cursor):
    noted(task, cursor, "single")
    return ([json.dumps({"id": task["id"], "n": -1})], None) if task["id"] == 3 else ([], None)
'''


def test_harvest_resumes_without_asking_twice(spark, tmp_path, monkeypatch):
    folder = tmp_path / "fetchers"
    folder.mkdir()
    (folder / "harvest_fetchers.py").write_text(FETCHERS)
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    monkeypatch.setitem(env, "PYTHONPATH", os.pathsep.join([str(folder), env.get("PYTHONPATH", ""), root]))
    tasks = spark.createDataFrame([(json.dumps({"id": k}),) for k in (2, 3, 4, 5, 6, 9)], "task string")
    ledger, steps, waits = f"file://{tmp_path}/ledger", ("harvest_fetchers:paged", "harvest_fetchers:single"), []
    part = harvest.harvest(tasks, ledger, *steps, pages=2, rounds=1, wait=waits.append)
    assert 0 < part.where("record is not null").count() < 14
    rows = harvest.harvest(tasks, ledger, *steps, pages=2, wait=waits.append).collect()
    found = Counter(json.loads(r.task)["id"] for r in rows if r.record)
    assert found == {2: 2, 4: 4, 6: 6, 3: 1}
    assert {json.loads(r.task)["id"]: r.error for r in rows if r.error} == {5: "no results found", 9: "ValueError: never"}
    asked = Counter((folder / "asked").read_text().splitlines())
    assert max(asked.values()) == 1 and len(asked) == 2 + 4 + 6 + 2 * 2
    assert len(waits) == 1 and 0 < waits[0] <= 7.5
    again = harvest.harvest(tasks, ledger, *steps, wait=waits.append).count()
    assert again == len(rows) and (folder / "asked").read_text().count("\n") == sum(asked.values())
