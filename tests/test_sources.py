"""Digests of the files that a bundle is made of, and what is said when they change."""

from profilespark.contract import SURVEY
from profilespark.sources.bundle import Bundle
from profilespark.sources.readers import manifest_changes, manifest_notes, source_manifest


def write(folder, **files):
    for name, text in files.items():
        path = folder / f"{name.replace('__', '/')}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(folder)


def test_changes_by_file(spark, tmp_path):
    then = source_manifest(spark, write(tmp_path / "then", a="1", b="2", sub__c="3")).cache()
    assert sorted(r.file for r in then.collect()) == ["a.csv", "b.csv", "sub/c.csv"] and {r.length for r in then.collect()} == {1}
    now = source_manifest(spark, write(tmp_path / "now", a="1", b="x", d="4"))
    changes = manifest_changes(now, then)
    assert {r.file: r.status for r in changes.collect()} == {"a.csv": "same", "b.csv": "changed", "sub/c.csv": "missing", "d.csv": "new"}
    assert [n.split(": ")[1] for n in manifest_notes(changes)] == ["1 changed (b.csv).", "1 missing (sub/c.csv).", "1 new (d.csv)."]
    assert manifest_notes(manifest_changes(then, then)) == []
    one = source_manifest(spark, str(tmp_path / "then" / "a.csv")).collect()
    assert [r.file for r in one] == ["a.csv"]


def test_a_bundle_says_that_its_source_has_changed(spark, tmp_path):
    path = write(tmp_path / "data", part="a,b\n1,2\n")
    files = source_manifest(spark, path)
    bundle = Bundle(SURVEY, None, {}, None, None, {"source": {"path": path, "files": 1}}, {"sources": spark.createDataFrame(files.collect(), files.schema)})
    assert bundle.source_notes() == []
    write(tmp_path / "data", part="a,b\n1,3\n")
    assert "1 changed (part.csv)" in bundle.source_notes()[0]
    assert Bundle(SURVEY, None, {}, None, None, {}).source_notes() == []
