import pytest

from spanseek.operators import catalog


@pytest.fixture
def files(spark):
    paths = ["b.PY", "a/c.py", "a.py", "Makefile", ".hid/x.py", "a/.env", "z/Dockerfile", "m.tar.gz"]
    return spark.createDataFrame([(p, p, float(i)) for i, p in enumerate(paths)], "path string, rel_path string, mtime double")


def test_hidden(files, rows):
    kept = [r[0] for r in rows(catalog.drop_hidden(files), "path")]
    assert ".hid/x.py" not in kept and "a/.env" not in kept and len(kept) == 6


def test_report(files):
    found = [tuple(r) for r in catalog.extension_report(files).collect()]
    assert found == [
        (".py", 4, 50.0),
        (".gz", 1, 12.5),
        ("no_ext", 3, 37.5),
        ("total", 8, 100.0),
    ]


def test_report_of_nothing(files):
    assert catalog.extension_report(files.where("false")).count() == 0


def test_extension_list(files):
    assert [r.ext for r in catalog.extension_list(files).collect()] == [".gz", ".py", ""]


@pytest.mark.parametrize("asked", ["PY", ".py", ".Py"])
def test_find(files, asked):
    assert [r.path for r in catalog.find_by_extension(files, asked).collect()] == ["a/c.py", "a.py", "b.PY"]


def test_find_without_suffix_and_hidden(files):
    found = catalog.find_by_extension(files, "No-Ext", include_hidden=True)
    assert [r.path for r in found.collect()] == ["Makefile", "a/.env", "z/Dockerfile"]


def test_tree_status(files):
    assert tuple(catalog.tree_status(files, [".py", ""]).first()) == (6, 6.0)
    assert tuple(catalog.tree_status(files, [".zip"]).first()) == (0, 0.0)


def test_allowed_extensions(spark, rows):
    asked = spark.createDataFrame([(".py",), (".zip",), (".zip",)], "ext string")
    allowed = spark.createDataFrame([(e,) for e in catalog.ALLOWED_EXTENSIONS], "ext string")
    assert rows(catalog.unknown_extensions(asked, allowed)) == [(".zip",)]
    assert len(catalog.ALLOWED_EXTENSIONS) == 36
    assert catalog.check_extensions([".py", ""]) == [".py", ""]
    for bad in ([], [".zip"]):
        with pytest.raises(ValueError):
            catalog.check_extensions(bad)
