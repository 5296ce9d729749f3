"""Bundles: an inventory that counts nothing twice, restarts, and the log of a run."""

import json

import pytest

from docsieve.operators import xpaths
from docsieve.plans import session
from docsieve.streaming import jobs
from docsieve.streaming.runlog import RunLog


def found(spark, *texts):
    return xpaths.inventory(spark.createDataFrame([(t,) for t in texts], "xml string"))


def state(spark, folder):
    return {r.xpath: (r.countElement, r.attributes) for r in jobs.path_state(spark, folder).collect()}


def test_a_bundle_done_again_counts_once(spark, tmp_path):
    folder = str(tmp_path / "bundles")
    assert state(spark, folder) == {}
    each = [found(spark, f'<a k{i}="1"><b/></a>', "<a/>") for i in range(4)]
    for i, e in enumerate(each):
        jobs.merge_paths(e, folder, i)
    want = {"/a": (8, ["k0", "k1", "k2", "k3"]), "/a/b": (4, [])}
    assert state(spark, folder) == want
    jobs.merge_paths(each[2], folder, 2)
    assert state(spark, folder) == want
    jobs.compact_paths(spark, folder, least=5)  # too few
    jobs.compact_paths(spark, folder, least=4)
    assert [p.name for p in sorted((tmp_path / "bundles").iterdir())] == ["merged=3"] and state(spark, folder) == want
    jobs.merge_paths(each[3], folder, 3)  # done again after it was merged
    assert state(spark, folder) == want
    jobs.merge_paths(each[0], folder, 4)
    jobs.compact_paths(spark, folder, least=1)
    assert state(spark, folder) == {"/a": (10, ["k0", "k1", "k2", "k3"]), "/a/b": (5, [])}


def test_bundles_of_a_session_with_a_restart(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    for i in range(3):
        (src / f"{i}.xml").write_text(f'<?xml version="1.0"?><a n="{i}"><b/></a>')
    config = session.SessionConfig("corp", str(src), str(out), stages=("walk", "filetype", "xml", "xpaths", "bayes", "out"), bundle=2)
    assert len(session.launch(spark, config)) == 2
    lines = lambda: sorted(x for f in (out / "xpaths" / "xpaths.csv").glob("part-*") for x in f.read_text().splitlines())
    assert lines() == ["/a/b;3;", "/a;3;n"]
    (src / "3.xml").write_text('<?xml version="1.0"?><a m="1"/>')
    done = session.launch(spark, config)  # only the new file
    assert [d.rpartition("=")[2] for d in done] == ["2"] and lines() == ["/a/b;3;", "/a;4;m,n"]
    # the last bundle's commit is lost: it is done again, and nothing counts twice
    commits = [p for p in (out / "checkpoint" / "commits").iterdir() if p.name in ("2", ".2.crc")]
    for p in commits:
        p.unlink()
    assert [d.rpartition("=")[2] for d in session.launch(spark, config)] == ["2"] and lines() == ["/a/b;3;", "/a;4;m,n"]
    log = [(r.kind, r.message) for r in RunLog(spark, f"{out}/log").entries().orderBy("time").collect()]
    assert [x for x in log if x[0] == "warning"] == [("warning", "bayes: needs a model")] * 3
    kinds = [m for _, m in log]
    assert kinds.count("session started") == kinds.count("session ended") == 3 and kinds.count("stream started") == 3 and "bundle 0: 2 files" in kinds


def test_errors_and_warnings_are_logged(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.xml").write_text('<?xml version="1.0"?><a/>')
    config = session.SessionConfig("corp", str(src), str(tmp_path / "out"), stages=("walk", "filetype", "xml", "out"), metadata=({"name": "x", "type": "String", "xpath": "//a[["},))
    session.launch(spark, config)
    log = {(r.kind, r.message) for r in RunLog(spark, str(tmp_path / "out" / "log")).entries().collect()}
    assert ("warning", "1 records with an error") in log
    with pytest.raises(Exception):
        session.launch(spark, session.replace(config, input_path=str(tmp_path / "nowhere")))
    last = [r for r in RunLog(spark, str(tmp_path / "out" / "log")).entries().collect() if r.kind == "error"]
    assert len(last) == 1 and "nowhere" in last[0].message and "Traceback" in last[0].stack and json.dumps(last[0].time)
    with pytest.raises(ValueError):
        RunLog(spark, str(tmp_path / "log")).write("other", "x")
