import pytest

from tomeworks import cli


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    for n, text in (("a.pdf", "1"), ("b.pdf", "1"), ("sub/c.pdf", "2")):
        (root / n).write_text(text)
    return root


def test_dedupe_moves(spark, folder, tmp_path, capsys):
    assert cli.main(["dedupe", str(folder), "--dest", str(tmp_path / "out")]) == 0
    assert (tmp_path / "out/b.pdf").exists()
    assert not (folder / "b.pdf").exists()
    assert (folder / "a.pdf").exists()
    cli.main(["count", str(folder)])
    assert capsys.readouterr().out.strip().endswith("2")


def test_dedupe_removes(spark, folder):
    cli.main(["dedupe", str(folder), "--rm", "--dry-run"])
    assert (folder / "b.pdf").exists()
    cli.main(["dedupe", str(folder), "--rm"])
    assert not (folder / "b.pdf").exists()
    with pytest.raises(SystemExit):
        cli.main(["dedupe", str(folder)])


def test_copy_and_flatten(spark, folder, tmp_path, capsys):
    cli.main(["copy", str(folder), "--dest", str(tmp_path / "to"), "--deduplicate"])
    assert sorted(contents(tmp_path / "to")) == ["a.pdf", "sub/c.pdf"]  # places below the source stay
    cli.main(["flatten", str(folder)])
    assert (folder / "sub_c.pdf").exists()
    assert (folder / "a.pdf").exists()
    cli.main(["check", str(folder)])
    assert "a.pdf" in capsys.readouterr().out


def contents(root):
    return {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file()}


def write(root, files):
    for name, text in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)


def test_copy_leaves_what_is_there(spark, tmp_path, capsys):
    one, two, to = tmp_path / "one", tmp_path / "two", tmp_path / "to"
    write(one, {"x.pdf": "new", "sub/y.pdf": "y", "sub/z.pdf": "one"})
    write(two, {"sub/z.pdf": "two", "w.pdf": "y"})
    write(to, {"x.pdf": "old"})
    cli.main(["copy", str(one), str(two), "--dest", str(to), "--dry-run"])
    assert contents(to) == {"x.pdf": "old"}
    cli.main(["copy", str(one), str(two), "--dest", str(to)])
    assert contents(to) == {"x.pdf": "old", "sub/y.pdf": "y", "sub/z.pdf": "one", "w.pdf": "y"}
    assert sorted(line.split()[0] for line in capsys.readouterr().out.splitlines()[-5:]) == ["done"] * 3 + ["exists"] * 2
    cli.main(["copy", str(one), str(two), "--dest", str(to), "--overwrite"])
    assert contents(to) == {"x.pdf": "new", "sub/y.pdf": "y", "sub/z.pdf": "two", "w.pdf": "y"}
    assert contents(one) == {"x.pdf": "new", "sub/y.pdf": "y", "sub/z.pdf": "one"}
    cli.main(["copy", str(one), str(two), "--dest", str(tmp_path / "third"), "--deduplicate", "--max-files", "2"])
    assert contents(tmp_path / "third") == {"sub/y.pdf": "y", "sub/z.pdf": "one"}


def test_dedupe_numbers_what_is_taken(spark, tmp_path):
    root, to = tmp_path / "in", tmp_path / "out"
    write(root, {"a.pdf": "1", "b.pdf": "1", "sub/b.pdf": "1"})
    write(to, {"b.pdf": "earlier", "b_1.pdf": "earlier too", "b_3.pdf": "third"})
    cli.main(["dedupe", str(root), "--dest", str(to)])
    assert contents(root) == {"a.pdf": "1"}
    assert contents(to) == {"b.pdf": "earlier", "b_1.pdf": "earlier too", "b_2.pdf": "1", "b_3.pdf": "third", "sub/b.pdf": "1"}
    write(root, {"b.pdf": "1"})
    cli.main(["dedupe", str(root), "--dest", str(to)])
    assert contents(to)["b_4.pdf"] == "1"


def test_flatten_loses_nothing(spark, tmp_path, capsys):
    write(tmp_path, {"a/b_c.pdf": "1", "a_b/c.pdf": "2", "top.pdf": "3", "d/e.pdf": "4", "d_e.pdf": "5"})
    before = sorted(contents(tmp_path).values())
    cli.main(["flatten", str(tmp_path)])
    got = contents(tmp_path)
    assert sorted(got.values()) == before
    assert got == {"a_b_c.pdf": "1", "a_b/c.pdf": "2", "top.pdf": "3", "d/e.pdf": "4", "d_e.pdf": "5"}
    assert capsys.readouterr().out.count("exists") == 2


def test_targets_replace_the_beginning_only(spark, tmp_path):
    root = tmp_path / "x"
    inner = str(root).lstrip("/") + "/b.pdf"  # the root occurs twice in the path
    write(root, {"a.pdf": "1", inner: "1", "a2.pdf": "1"})
    cli.main(["dedupe", str(root), "--dest", str(tmp_path / "out")])
    assert contents(tmp_path / "out") == {"a2.pdf": "1", inner: "1"}
