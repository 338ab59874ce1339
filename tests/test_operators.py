import io
import sqlite3
import tarfile
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tomeworks.operators import dedupe, keywords, publishers
from tomeworks.providers import base as P
from tomeworks.sources import archives, files, run_log, sqlite
from tomeworks.streaming import listen


def test_discovery(spark, tmp_path):
    (tmp_path / "nested").mkdir()
    for n in ("a.pdf", "b.txt", "nested/c.pdf", "d.PDF"):
        (tmp_path / n).write_bytes(b"%PDF-1.4 " + n.encode() + b" %%EOF")
    assert files.count_files(spark, str(tmp_path)) == 2
    assert files.discover(spark, str(tmp_path), case_insensitive=True).count() == 3
    got = files.discover(spark, str(tmp_path))
    assert got.where(files.looks_valid(F.col("content"))).count() == 2
    assert files.with_hash(got).select("content_hash").distinct().count() == 2
    with pytest.raises(RuntimeError):
        files.count_files(spark, str(tmp_path / "missing"))
    with pytest.warns(UserWarning):
        assert files.expand_paths([str(tmp_path / "*.none"), "plain"]) == ["plain"]


def test_moves_are_repeatable(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    plan = spark.createDataFrame([(f"file:{tmp_path}/a.txt", f"file:{tmp_path}/out/b.txt"), (f"file:{tmp_path}/none", f"file:{tmp_path}/out/c")], "path string, dest string")
    assert {r["status"] for r in files.move_files(plan, dry_run=True).collect()} == {"planned"}
    for _ in range(2):
        status = sorted(r["status"][:6] for r in files.move_files(plan).collect())
        assert status == ["done", "failed"]
    assert (tmp_path / "out/b.txt").read_text() == "x"


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/one.txt", "1")
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("two.txt")
        info.size = 1
        t.addfile(info, io.BytesIO(b"2"))
    (tmp_path / "c.zip").write_bytes(b"broken")
    got = {(r["archive"][-1], r["member"], r["error"] is None) for r in archives.members(files.discover(spark, str(tmp_path), "*")).collect()}
    assert got == {("p", "x/one.txt", True), ("z", "two.txt", True), ("p", None, False)}


def test_first_seen_and_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, "y"), (5, None)], "id int, k string")
    got = {r["id"]: (r["status"], r["first_seen"]) for r in dedupe.first_seen(df, F.col("k"), "id").collect()}
    assert got == {1: ("unique", 1), 2: ("duplicate", 1), 3: ("unique", 3), 4: ("unique", 4), 5: ("unique", 5)}
    names = spark.createDataFrame([(1, "x.pdf"), (2, "x.pdf"), (3, "x.pdf"), (4, "y")], "id int, target string")
    assert [r["dest"] for r in dedupe.free_names(names, "target", "id").orderBy("id").collect()] == ["x.pdf", "x_1.pdf", "x_2.pdf", "y"]
    moved = dedupe.flatten_plan(spark.createDataFrame([("r/a/b.txt",), ("b.txt",)], "path string"), "path").collect()
    assert [r["dest"] for r in moved] == ["r/a_b.txt"]
    assert {r["chunk"]: r["count"] for r in dedupe.chunk_ids(spark.range(25), "id", 10).groupBy("chunk").count().collect()} == {0: 10, 1: 10, 2: 5}


def test_publisher_groups_are_greedy(spark):
    raw = ["Chaosium", "Chaosium Inc", "Wizards of the Coast", "Wizards of Coast", "Paizo Inc", "Paizo", "abcdefgh", "abcdefxy", "abcdwxyz"]
    df = spark.createDataFrame(list(enumerate(raw)), "id int, p string")
    names = publishers.publisher_names(df, "p", "id")
    pairs = publishers.fuzzy_pairs(names)
    got = {r["name"]: r["canonical"] for r in publishers.canonical_names(publishers.greedy_groups(names, pairs)).collect()}
    assert got["Chaosium Inc"] == "Chaosium"
    assert got["Wizards of the Coast"] == "Wizards of Coast"
    assert got["Paizo Inc"] == "Paizo"
    assert got["abcdefxy"] == "abcdefgh"
    assert got["abcdwxyz"] == "abcdwxyz"
    assert len(got) == len(raw)


def brute_pairs(norms, threshold=75.0):
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for c in a:
            old = row[:]
            for k, d in enumerate(b):
                row[k + 1] = old[k] + 1 if c == d else max(row[k], old[k + 1])
        return row[-1]

    out = set()
    for a in norms:
        for b in norms:
            if a < b and (200 * lcs(a, b) / (len(a) + len(b)) >= threshold or b.startswith(a) or a.startswith(b)):
                out.add((a, b))
    return out


def test_fuzzy_pairs_lose_nothing(spark):
    rng = np.random.default_rng(3)
    norms = sorted({"".join(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(60)})
    df = spark.createDataFrame([(n, n, i) for i, n in enumerate(norms)], "name string, norm string, pos int")
    assert {(r["a"], r["b"]) for r in publishers.fuzzy_pairs(df).collect()} == brute_pairs(norms)


def test_average_linkage():
    rng = np.random.default_rng(0)
    centres = np.eye(3)
    x = np.concatenate([c + rng.normal(0, 0.05, (10, 3)) for c in centres])
    got = keywords.average_linkage(x, clusters=3)
    assert [len(set(got[i : i + 10])) for i in (0, 10, 20)] == [1, 1, 1]
    assert len(set(got)) == 3
    assert len(set(keywords.average_linkage(x, distance=0.2))) == 3
    assert len(set(keywords.average_linkage(x, clusters=100))) == 30
    with pytest.raises(ValueError):
        keywords.average_linkage(x)


def test_canonical_keywords(spark):
    rows = spark.createDataFrame([(1, ["Dark-Fantasy", "dark fantasy", "Gone"]), (2, [])], "id int, words array<string>")
    mapping = spark.createDataFrame([("darkfantasy", "fantasy"), ("dark fantasy", "fantasy"), ("gone", "")], "keyword string, label string")
    got = {r["id"]: r["canonical"] for r in keywords.apply_canonical(rows, "id", "words", mapping).collect()}
    assert got == {1: ["fantasy"]}


def test_sqlite_source(spark, tmp_path):
    path = str(tmp_path / "runs.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE runs (id INTEGER, result TEXT)")
        c.executemany("INSERT INTO runs VALUES (?, ?)", [(i, f'{{"title": "t{i}"}}') for i in range(10)])
    sqlite.register(spark)
    got = spark.read.format("sqlite_table").option("path", path).option("table", "runs").load()
    assert got.count() == 10
    assert got.where("id = 3").first()["result"] == '{"title": "t3"}'


def test_run_log(spark, tmp_path):
    runs = spark.createDataFrame([("a.pdf", "h", "{}", '{"title": "T", "keywords": ["b", "a", "b"], "author": "A"}', "2026-01-02 03:04:05")], "pdf_name string, pdf_hash string, pipeline_config string, result string, at string")
    runs = runs.withColumn("run_timestamp", F.to_timestamp("at")).drop("at")
    assert run_log.append_runs(runs, str(tmp_path / "log"))
    assert not run_log.append_runs(runs, "nowhere://x/y")
    got = run_log.parsed(run_log.read_runs(spark, str(tmp_path / "log"))).first()
    assert (got["title"], got["keywords"], got["author"]) == ("T", ["a", "b"], ["A"])


def test_providers(spark):
    calls = []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise P.ProviderError("busy", 503)
        return x.upper()

    assert P.retrying(flaky, sleep=lambda s: None)("a") == "A"
    with pytest.raises(P.ProviderError):
        P.retrying(lambda x: (_ for _ in ()).throw(P.ProviderError("no", 404)), sleep=lambda s: None)("a")
    with pytest.raises(ValueError):
        P.provider("unknown")
    with pytest.raises(ValueError):
        P.ContextLimits(first_images=-1)
    assert "<redacted>" in P.PipelineConfig(client={"api_key": "x", "host": None}).to_json()
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, request string")
    assert sorted((r["id"], r["response"], r["error"]) for r in P.ask(df, "id", "request", "echo").collect()) == [(1, "x", None), (2, None, None)]


def test_folder_stream(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    for n, text in (("a.pdf", "1"), ("b.pdf", "1"), ("sub/c.pdf", "2"), ("d.txt", "3")):
        (tmp_path / "in" / n).write_text(text)
    stream = listen.listen_folder(spark, str(tmp_path / "in")).select("path", "content_hash")
    listen.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).select("content_hash").distinct().count() == spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_cluster_average_large_label(spark, tmp_path):
    """A label of more than 400 vectors: its 8 true clusters, each whole; and cells that share out the clusters."""
    from tomeworks.plans import catalog

    rng = np.random.default_rng(3)
    centres = np.eye(8) * 10
    rows = [(i, (centres[i % 8] + rng.normal(0, 0.1, 8)).tolist(), 1) for i in range(900)] + [(1000 + i, centres[i % 8].tolist(), 2) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = catalog.QUERIES["cluster_average"](spark, str(tmp_path)).toPandas()
    assert len(got) == len(rows)
    big = got[got.vec_id < 900]
    assert big.groupby(["block", "cluster_id"]).ngroups == 8
    assert big.assign(true=big.vec_id % 8).groupby("true").cluster_id.nunique().max() == 1
    cut = catalog._cells(df, 8, most=300).toPandas()
    assert len(cut) == len(rows)
    assert cut.groupby("block").vec_id.count().max() <= 500
    assert 7 <= cut[cut.label == 1].drop_duplicates("block").share.sum() <= 9
    assert cut[cut.label == 2].share.tolist() == [8] * 20


def test_greedy_groups_long_chain(spark):
    """A chain of more than 50 matches is one part: only its least name's order tells who founds a group."""
    name = lambda i: f"n{i:03d}"
    n = 54
    names = spark.createDataFrame([(name(i), name(i), n - i) for i in range(n)], "name string, norm string, pos int").coalesce(1)
    pairs = spark.createDataFrame([(name(i), name(i + 1)) for i in range(n - 1)], "a string, b string").coalesce(1)
    got = {r["norm"]: r["seed"] for r in publishers.greedy_groups(names, pairs).collect()}
    assert got == {name(i): name(i if i % 2 else i + 1) for i in range(n)}


@pytest.mark.parametrize("threshold", [40.0, 75.0, 90.0])
def test_fuzzy_pairs_of_many_lengths(spark, threshold):
    """Lengths from one letter on, repeated letters, prefixes, and names at the edge of a band, at shares on both sides of a half."""
    rng = np.random.default_rng(5)
    norms = sorted({"".join(rng.choice(list("aabc d"), rng.choice((1, 2, 3, 5, 9, 15, 25)))).strip() for _ in range(60)} - {""})
    got = publishers.fuzzy_pairs(spark.createDataFrame([(n,) for n in norms], "norm string"), threshold).collect()
    assert len(got) == len({(r["a"], r["b"]) for r in got})
    assert {(r["a"], r["b"]) for r in got} == brute_pairs(norms, threshold)


def test_apply_canonical(spark):
    rows = spark.createDataFrame([(1, ["Sci-Fi", "scifi", None, "..."]), (2, ["Noise", "War"]), (3, []), (4, None)], "id int, words array<string>")
    mapping = spark.createDataFrame([("scifi", "science fiction"), ("noise", "")], "keyword string, label string")
    got = {r["id"]: r["canonical"] for r in keywords.apply_canonical(rows, "id", "words", mapping).collect()}
    assert got == {1: ["science fiction"], 2: ["war"]}


def test_cluster_map_blocks(spark, tmp_path):
    from tomeworks.plans import catalog

    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(0, 0.05, 4) + np.eye(4)[i % 2]], 7 if i < 900 else None) for i in range(930)]
    spark.createDataFrame([*rows, (1000, None, 7)], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = catalog.QUERIES["cluster_map"](spark, str(tmp_path)).toPandas()
    assert sorted(got.vec_id) == list(range(930))
    assert got.groupby("block").size().to_dict() == {"7-0": 900, "none-0": 30}


def test_free_names_among_taken(spark):
    rng = np.random.default_rng(8)
    rows = [(i, f"d/n{rng.integers(4)}.pdf") for i in range(60)] + [(100, "d/n1_2.pdf"), (101, "plain"), (102, "plain"), (103, "d/n2_7.pdf")]
    taken = ["d/n0.pdf", "d/n1_1.pdf", "d/n1_5.pdf", "d/n1_1_1.pdf", "e/n0_1.pdf", "plain_1", "d/n2_01.pdf", *(f"d/n3_{k}.pdf" for k in range(1, 9))]
    got = dedupe.free_names(spark.createDataFrame(rows, "id int, target string"), "target", "id", spark.createDataFrame([(p,) for p in taken], "path string"))
    used, want = set(taken) | {t for _, t in rows}, {}
    first = {}
    for i, t in rows:  # one after the other, names that others want as they are aside
        stem, dot, ext = t.rpartition(".") if "." in t else (t, "", "")
        name, k = t, 0
        while name in used and not (k == 0 and t not in taken and first.setdefault(t, i) == i):
            k += 1
            name = f"{stem}_{k}{dot}{ext}"
        used.add(name)
        want[i] = name
    assert {r["id"]: r["dest"] for r in got.collect()} == want
    assert len(set(want.values())) == len(rows)


def test_file_actions(spark, tmp_path):
    """An aborted or repeated attempt changes nothing; the commit places what counts, once, where nothing lies."""
    from tomeworks.sources.actions import FileActionsWriter

    for n in ("a", "b", "c"):
        (tmp_path / n).write_text(n)
    (tmp_path / "there").write_text("old")
    rows = [{"source": f"file:{tmp_path}/{a}", "dest": f"file:{tmp_path}/{b}"} for a, b in (("a", "out/a"), ("b", "there"), ("c", "out/a"), ("none", "x"))]
    rows.append({"source": None, "dest": "y"})
    look = lambda: {str(p.relative_to(tmp_path)): p.read_text() for p in tmp_path.rglob("*") if p.is_file() and ".job" not in str(p)}
    before = look()
    job = tmp_path / ".job"
    writer = FileActionsWriter({"job": str(job)})
    writer.abort([writer.write(iter(rows)), None])
    assert look() == before and not job.exists()
    writer.write(iter(rows))  # an attempt whose task was lost
    writer.commit([None, writer.write(iter(rows))])
    after = look()
    assert sorted(after.values()) == ["a", "b", "c", "old"] or sorted(after.values()) == ["b", "c", "c", "old"]
    assert after["there"] == "old" and after["b"] == "b"
    assert {after["out/a"]} | {after.get("a"), after.get("c")} >= {"a", "c"}  # one of the two moved, the other stayed
    status = sorted(line.split('"status": "')[1].split('"')[0].split(":")[0] for line in (job / "status-0.json").read_text().splitlines())
    assert status == ["done", "exists", "exists", "failed", "failed"]
    plan = spark.createDataFrame([(f"{tmp_path}/b", f"{tmp_path}/new/b"), (f"{tmp_path}/there", f"{tmp_path}/there")], "path string, dest string")
    for _ in range(2):
        assert [r["status"] for r in files.move_files(plan).collect()] == ["done", "done"]
    assert look()["new/b"] == "b" and look()["there"] == "old" and "b" not in look()
    assert files.move_files(plan.where("false")).count() == 0
    copied = files.move_files(spark.createDataFrame([(f"{tmp_path}/there", f"{tmp_path}/new/b")], "path string, dest string"), copy=True, overwrite=True)
    assert [r["status"] for r in copied.collect()] == ["done"]
    assert look()["new/b"] == look()["there"] == "old"
    assert not list(tmp_path.rglob(".tomeworks*"))


@pytest.mark.parametrize("last", [100_000, 40, 0])
def test_greedy_groups_in_rounds(spark, monkeypatch, last):
    """Founders and their groups against taking the names one after the other, by rounds and in one task."""
    monkeypatch.setattr(publishers, "LAST", last)
    rng = np.random.default_rng(6)
    n = 120
    pos = rng.integers(0, 60, n).tolist()  # ties go by name
    pairs = {tuple(sorted((f"n{x:03d}", f"n{y:03d}"))) for x, y in rng.integers(0, n, (260, 2)).tolist()} | {(f"n{k:03d}", "n000") for k in range(1, 40)} | {("n005", "n005")}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    seed = {}
    for p, norm in sorted((p, f"n{i:03d}") for i, p in enumerate(pos)):
        if norm not in seed:
            seed[norm] = norm
            for other in near.get(norm, ()):
                seed.setdefault(other, norm)
    names = spark.createDataFrame([(f"n{i:03d}", f"n{i:03d}", p) for i, p in enumerate(pos)], "name string, norm string, pos int")
    got = {r["norm"]: r["seed"] for r in publishers.greedy_groups(names, spark.createDataFrame(sorted(pairs), "a string, b string")).collect()}
    assert got == seed


@pytest.mark.parametrize("n,last,order", [(20_000, 100_000, "falling"), (60_000, 1000, "mixed")])
def test_greedy_groups_of_a_long_chain(spark, monkeypatch, n, last, order):
    """Each name matches the next: in falling order one bounded task decides, in a mixed one the rounds leave it no more than `last`."""
    monkeypatch.setattr(publishers, "LAST", last)
    pos = {i: n - i if order == "falling" else i * 7919 % n for i in range(n)}
    names = spark.createDataFrame([(f"c{i:06d}", f"c{i:06d}", p) for i, p in pos.items()], "name string, norm string, pos int")
    pairs = spark.range(n - 1).selectExpr("format_string('c%06d', id) AS a", "format_string('c%06d', id + 1) AS b")
    seed = {}
    for i in sorted(pos, key=pos.get):
        if i not in seed:
            seed[i] = i
            for k in (i - 1, i + 1):
                seed.setdefault(k, i)
    got = publishers.greedy_groups(names, pairs).toPandas()
    assert dict(zip(got.norm, got.seed, strict=True)) == {f"c{i:06d}": f"c{seed[i]:06d}" for i in range(n)}


def test_sqlite_filters_reach_the_statement(spark, tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringStartsWith

    path = str(tmp_path / "runs.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE runs (id INTEGER, name TEXT, score REAL)")
        c.executemany("INSERT INTO runs VALUES (?, ?, ?)", [(i, None if i % 7 == 0 else f"n{i % 5}", i / 2) for i in range(100)])
    sqlite.register(spark)
    table = spark.read.format("sqlite_table").option("path", path).option("table", "runs").load()
    reader = sqlite.SqliteTable({"path": path, "table": "runs", "filters": "true"}).reader(table.schema)
    given = [EqualTo(("name",), "n1"), GreaterThan(("id",), 5), GreaterThan(("score",), 1.0), In(("id",), (1, 2, 61)), IsNotNull(("name",)), StringStartsWith(("name",), "n"), EqualTo(("id",), "5")]
    assert list(reader.pushFilters(given)) == [given[2], given[5], given[6]]
    sql, values = reader.statement(sqlite.Range(1, 101))
    assert sql.endswith('WHERE rowid >= ? AND rowid < ? AND "name" = ? AND "id" > ? AND "id" IN (?, ?, ?) AND "name" IS NOT NULL')
    assert values == [1, 101, "n1", 5, 1, 2, 61]
    for condition in ("id = 61", "name = 'n1' AND id > 50", "name IS NULL", "id IN (3, 4, 700)", "score > 30 AND id <= 70", "name >= 'n3' OR id = 1", "name LIKE 'n2%'", "NOT name = 'n1'"):
        got = sqlite.rows_where(spark, path, "runs", condition)
        want = spark.createDataFrame(table.collect(), table.schema).where(condition)
        assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect()), condition
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    plan = sqlite.filtered(spark, path, "runs").where("name = 'n1' AND id > 50")._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter (" not in plan  # the scan does it all
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    assert table.where("name >= 'n3' OR id = 1").count() == sqlite.rows_where(spark, path, "runs", "name >= 'n3' OR id = 1").count()


def test_archive_members_laterally(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/one.txt", "1")
        z.writestr("../out.txt", "2")
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("two.txt")
        info.size = 1
        t.addfile(info, io.BytesIO(b"2"))
    (tmp_path / "c.zip").write_bytes(b"broken")
    (tmp_path / "d.txt").write_bytes(b"no archive")
    found = files.discover(spark, str(tmp_path), "*")
    found.createOrReplaceTempView("found_files")
    archives.register(spark)
    want = {(r["archive"], r["member"], bytes(r["content"] or b""), r["error"]) for r in archives.members(found).collect()}
    got = {(r["path"], r["member"], bytes(r["content"] or b""), r["error"]) for r in spark.sql("SELECT path, m.* FROM found_files, LATERAL archive_members(path, content) m").collect()}
    assert got == want and len(want) == 4
    assert spark.sql("SELECT m.* FROM found_files, LATERAL archive_members(path, content, false) m").columns == ["member", "below", "error"]
    with pytest.raises(Exception, match="path and its content"):
        spark.sql("SELECT * FROM archive_members(1, 2)").collect()
