from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillmatch import cli
from quillmatch.config import RetrievalConfig
from quillmatch.functions import text
from quillmatch.operators import output, retrieval, store
from quillmatch.sources import generate, tsv
from quillmatch.sources.files import Files, Scratch
from quillmatch.streaming import retrieval as streaming

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def _write(path, body, head=HEAD):
    path.write_bytes((head + body).encode() if isinstance(body, str) else head.encode() + body)
    return str(path)


def test_read_source(spark, tmp_path):
    path = _write(tmp_path / "s.tsv", 'S2-1\t"a ""q"" b"\t"line\nfeed"\tUS\nS2-2\tshort\nS2-3\tx\ty\tz\textra\n', "﻿" + HEAD)
    rows = tsv.read_source(spark, path, "S2-").orderBy("row_ord").collect()
    assert [tuple(r)[:4] for r in rows] == [("S2-1", 'a "q" b', "line\nfeed", "US"), ("S2-2", "short", "", ""), ("S2-3", "x", "y", "z")]
    with pytest.raises(Exception):
        tsv.read_source(spark, path, "S2-", strict=True).collect()
    with pytest.raises(Exception, match="invalid entity id"):
        tsv.read_source(spark, path, "S3-").collect()
    with pytest.raises(Exception):
        tsv.read_source(spark, _write(tmp_path / "h.tsv", "S2-1\ta\tb\tc\n", "id\tname\taddr\tc\n"), "S2-").collect()
    with pytest.raises(ValueError, match="UTF-8"):
        tsv.check_utf8(spark, _write(tmp_path / "u.tsv", b"S2-1\t\xff\xfe\n"))


def test_read_truth_and_lenient(spark, tmp_path):
    path = _write(tmp_path / "t.tsv", "S1-1\tS2-1,,S3-1\nS1-2\t\n", "source1_entity_id\tmatched_entity_ids\n")
    assert [tuple(r) for r in tsv.read_truth(spark, path).orderBy("source1_entity_id").collect()] == [("S1-1", ["S2-1", "S3-1"]), ("S1-2", [])]
    twice = _write(tmp_path / "d.tsv", "S1-1\tS2-1,S2-1\n", "source1_entity_id\tmatched_entity_ids\n")
    with pytest.raises(Exception, match="bad links"):
        tsv.read_truth(spark, twice).collect()
    loose = _write(tmp_path / "l.tsv", " S1-1 \t S2-1 , S2-1,, \nS1-2\n", "any\theader\n")
    assert [tuple(r) for r in tsv.read_links_lenient(spark, loose).collect()] == [("S1-1", ["S2-1"]), ("S1-2", [])]


def test_strict_reader(spark, tmp_path):
    path = _write(tmp_path / "o.tsv", "S1-1\ta,,b\nS1-1\tS2-2\nonly\n\tS2-1\nS1-3\t\n", " Source1_Entity_ID \tmatched_entity_ids\n")
    header, rows, bad = tsv.read_output_strict(spark, path)
    assert header == ["source1_entity_id", "matched_entity_ids"]
    assert [(r["line"], r["s1"], r["ids"]) for r in rows.orderBy("line").collect()] == [(2, "S1-1", ["a", "", "b"]), (3, "S1-1", ["S2-2"]), (6, "S1-3", [])]
    assert [r["line"] for r in bad.orderBy("line").collect()] == [4, 5]
    assert {r["s1"]: r["ids"] for r in tsv.last_rows(rows).collect()}["S1-1"] == ["S2-2"]


def test_line_numbers_over_many_blocks(spark, tmp_path):
    path = _write(tmp_path / "big.tsv", "".join(f"S1-{i}\tS2-{i}\n" for i in range(20_000)), "source1_entity_id\tmatched_entity_ids\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        _, rows, bad = tsv.read_output_strict(spark, path)
        assert rows.rdd.getNumPartitions() > 1 and bad.count() == 0
        assert {r["line"]: r["s1"] for r in rows.collect()} == {i + 2: f"S1-{i}" for i in range(20_000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_by_hadoop_paths(spark, tmp_path):
    files, here = Files(spark), f"file://{tmp_path}"
    files.write(f"{here}/a/x", b"one\n")
    files.write(f"{here}/a/x", b"two\n")
    files.write(f"{here}/a/y", b"")
    assert files.read(f"{here}/a/x") == b"two\n" and files.size(f"{here}/a") == 4 and [f.rsplit("/", 1)[1] for f in files.listed(f"{here}/a")] == ["x", "y"]
    files.concat(files.listed(f"{here}/a"), f"{here}/b", b"head\n")
    assert (tmp_path / "b").read_bytes() == b"head\ntwo\n" and not files.exists(f"{here}/a/x.part")
    for name in ("b", "a"):
        assert files.fingerprint(f"{here}/{name}") == tsv.fingerprint(str(tmp_path / name))
    before = files.fingerprint(f"{here}/a")
    files.write(f"{here}/a/x", b"TWO\n")
    assert files.fingerprint(f"{here}/a") != before
    scratch = Scratch(spark, "t")
    table = scratch.save(spark.range(3).toDF("i"), "t")
    assert table.count() == 3
    scratch.drop(table)
    assert files.exists(scratch.root) and not files.exists(f"{scratch.root}/1-t")


def test_archive(tmp_path):
    import zipfile

    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("d/x.tsv", "hello")
        z.writestr("d/skip.txt", "no")
    assert len(tsv.extract_archive(str(path), str(tmp_path / "out"), ("x.tsv",), tsv.fingerprint(str(path)))) == 1
    with pytest.raises(FileExistsError):
        tsv.extract_archive(str(path), str(tmp_path / "out"), ("x.tsv",))
    with pytest.raises(ValueError):
        tsv.extract_archive(str(path), str(tmp_path / "o2"), ("x.tsv",), "0" * 64)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("../x.tsv", "bad")
    with pytest.raises(ValueError, match="leaves"):
        tsv.extract_archive(str(path), str(tmp_path / "o3"), ("x.tsv",))
    (tmp_path / "p" / "q").mkdir(parents=True)
    assert tsv.find_archive("a.zip", str(tmp_path / "p" / "q")) == str(path.resolve())


@pytest.fixture
def files(spark, tmp_path):
    made = generate.scale_data(spark, 100)
    out = {}
    for name in ("source1", "source2", "source3"):
        rows = made[name].orderBy("row_ord").collect()
        out[name] = _write(tmp_path / f"{name}.tsv", "".join("\t".join(r[c] for c in ("entity_id", "business_name", "business_address", "country")) + "\n" for r in rows))
    truth = made["truth"].collect()
    out["truth"] = _write(tmp_path / "truth.tsv", "".join(f"{r[0]}\t{','.join(r[1])}\n" for r in truth), "source1_entity_id\tmatched_entity_ids\n")
    return out


def test_index_and_its_guards(spark, files, tmp_path):
    records = tsv.read_source(spark, files["source2"], "S2-").unionByName(tsv.read_source(spark, files["source3"], "S3-"))
    manifest = store.write(records, str(tmp_path), {"source2": files["source2"], "source3": files["source3"]})
    index = store.open_index(spark, f"{tmp_path}/manifest.json")
    assert index.total == 200 and manifest.rows["records"] == 200
    found = store.document_frequency(index, spark.createDataFrame([("business",), ("nothing",)], "token string")).collect()
    assert {r["token"]: r["df"] for r in found} == {"business": 200, "nothing": 0}
    with pytest.raises(Exception, match="no record"):
        index.lookup(spark.createDataFrame([("S2-nobody",)], "entity_id string")).collect()
    assert index.lookup(spark.createDataFrame([("S2-nobody",)], "entity_id string"), strict=False).count() == 0
    with pytest.raises(ValueError, match="split"):
        store.open_index(spark, manifest, split="train")
    with pytest.raises(ValueError, match="different splits"):
        store.one_split("a/train/x.tsv", "a/test/y.tsv")
    with pytest.raises(ValueError, match="repeated"):
        store.write(records.unionByName(records), str(tmp_path / "dup"), {})
    with open(files["source2"], "a") as f:
        f.write("S2-new\tx\ty\tz\n")
    with pytest.raises(ValueError, match="changed"):
        store.open_index(spark, manifest)


def test_outputs_round_trip(spark, files, tmp_path):
    q = spark.createDataFrame([("S1-1", 1), ("S1-0", 0), ("S1-2", 2)], "s1 string, row_ord long")
    lists = lambda rows: spark.createDataFrame(rows, "s1 string, ids array<string>")
    cands = lists([("S1-0", ["S3-1", "S2-1"]), ("S1-1", []), ("S1-2", ["S2-2"])])
    matches = lists([("S1-0", ["S2-1"]), ("S1-1", []), ("S1-2", [])])
    m, c = output.write_outputs(q, cands, matches, str(tmp_path / "o"))
    assert open(m).read() == "source1_entity_id\tmatched_entity_ids\nS1-0\tS2-1\nS1-1\t\nS1-2\t\n"
    assert open(c).read().splitlines()[1] == "S1-0\tS2-1,S3-1"
    s1 = _write(tmp_path / "s1.tsv", "".join(f"S1-{i}\ta\tb\tc\n" for i in range(3)))
    good = output.validate_files(spark, s1, m, c)
    assert good.passed and good.summary().startswith("PASS")
    assert (good.total_s1, good.matching_rows, good.empty_matching_rows, good.candidate_rows, good.empty_candidate_rows) == (3, 3, 2, 3, 1)
    with pytest.raises(ValueError, match="PREDICTION_NOT_SUBSET"):
        output.write_outputs(q, cands, lists([("S1-0", ["S2-9"]), ("S1-1", []), ("S1-2", [])]), str(tmp_path / "p"))
    assert not list((tmp_path / "p").glob("*")) if (tmp_path / "p").exists() else True
    kinds = lambda *a, **k: set(output.validate_files(spark, *a, **k).counts)
    assert kinds("/none", m, c) == {"MISSING_TEST_S1_FILE"} and kinds(s1, "/none", c) == {"MISSING_MATCHING_FILE"}
    assert kinds(s1, m) == {"MISSING_CANDIDATE_FILE"} and kinds(s1, m, require_candidates=False) == set()
    bad = _write(tmp_path / "bad.tsv", "S1-0\tS2-1,,X\nS1-0\tS2-1\none\n", "wrong\theader\n")
    assert {"WRONG_HEADER", "MALFORMED_ROW", "DUPLICATE_S1_ROW", "MISSING_S1_ROWS"} <= kinds(s1, bad, c)
    broken = _write(tmp_path / "enc.tsv", b"S1-0\t\xff\n", "source1_entity_id\tmatched_entity_ids\n")
    assert kinds(s1, broken, c) == {"ENCODING_ERROR"} and "ENCODING_ERROR" in kinds(s1, m, broken)


def test_every_malformed_line_is_a_finding(spark, tmp_path):
    s1 = _write(tmp_path / "s1.tsv", "".join(f"S1-{i}\ta\tb\tFrance\n" for i in range(40)))
    body = "".join(f"S1-{i}\tS2-{i}\n" if i % 2 else f"S1-{i} no tab {i}\n" for i in range(40)) + "S1-1\t\nS1-99\tS2-1,S2-1\n\tS2-5\n\nS1-3\tS2-3\tx\n"
    m = _write(tmp_path / "m.tsv", body, "source1_entity_id\tmatched_entity_ids\n")
    c = _write(tmp_path / "c.tsv", "".join(f"S1-{i}\tS2-{i}\n" for i in range(40)), "source1_entity_id\tcandidate_entity_ids\n")
    countries = spark.createDataFrame([(f"S1-{i}", " France " if i < 4 else "US") for i in range(40)], "s1 string, country string")
    corpus = spark.createDataFrame([(f"S2-{i}",) for i in range(30)], "entity_id string")
    found = output.validate_files(spark, s1, m, c, corpus, countries)
    # of an S1 that is there twice the last row counts; ids of candidates are checked too
    assert found.counts == {
        "MALFORMED_ROW": 22, "DUPLICATE_S1_ROW": 1, "MISSING_S1_ROWS": 1, "EXTRA_S1_ROWS": 1, "DUPLICATE_IDS": 1, "UNKNOWN_S2S3_IDS": 15, "FRANCE_COVERAGE": 1, "PREDICTION_NOT_SUBSET_OF_CANDIDATES": 1,
    }
    assert (found.total_s1, found.matching_rows, found.empty_matching_rows, found.candidate_rows, found.label_total, found.label_in_output) == (40, 21, 1, 40, 4, 2)
    lines = {r["context"] for r in found.findings.filter("problem_type = 'MALFORMED_ROW'").collect()}
    assert "matches: line 2 has 1 columns: S1-0 no tab 0" in lines and "matches: line 44 has 2 columns: \tS2-5" in lines and "matches: line 46 has 3 columns: S1-3\tS2-3\tx" in lines
    missing = found.findings.filter("problem_type = 'MISSING_S1_ROWS'").first()
    assert missing["context"] == "matches: 20" and len(missing["invalid_ids"]) == 10
    assert found.summary().startswith("FAIL: 43 findings") and "MALFORMED_ROW: 22" in found.summary()


def test_external_validator_is_looked_for_upwards(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "check.py").write_text("import sys\nprint(*sys.argv[1:])\nsys.exit(3)\n")
    assert output.run_external_validator("check.py", "x", "y", start=str(tmp_path / "a" / "b")) == (3, "x y\n")
    assert output.run_external_validator("other.py", start=str(tmp_path))[0] == 1


def test_train_then_predict(spark, tmp_path, capsys):
    """A model trained on one set of files decides those of the same kind; sweeps use the validation split."""
    names = [f"firm{i // 3:02d} kind{i % 40:02d}" for i in range(96)]
    row = lambda s, i, n: f"S{s}-{i}\t{n}\t{i} main street\tUS\n"
    paths = {
        "source1": _write(tmp_path / "s1.tsv", "".join(row(1, i, n) for i, n in enumerate(names))),
        "source2": _write(tmp_path / "s2.tsv", "".join(row(2, i, n) for i, n in enumerate(names))),
        "source3": _write(tmp_path / "s3.tsv", "".join(row(3, i, n + " works") for i, n in enumerate(names))),
        "truth": _write(tmp_path / "t.tsv", "".join(f"S1-{i}\tS2-{i},S3-{i}\n" for i in range(len(names))), "source1_entity_id\tmatched_entity_ids\n"),
    }
    assert cli.main(["index", "--source2", paths["source2"], "--source3", paths["source3"], "--folder", str(tmp_path)]) == 0
    common = ["--source1", paths["source1"], "--manifest", f"{tmp_path}/manifest.json"]
    assert cli.main(["train", *common, "--truth", paths["truth"], "--folder", str(tmp_path / "model"), "--rounds", "4"]) == 0
    model = ["--model", str(tmp_path / "model" / "model.json")]
    capsys.readouterr()
    assert cli.main(["sweep", *common, "--truth", paths["truth"], *model, "--thresholds", "0.3", "0.6"]) == 0
    assert capsys.readouterr().out.count("macro F0.5") == 4
    assert cli.main(["predict", *common, *model, "--source3-threshold", "0.99999", "--output", str(tmp_path / "out")]) == 0
    rows = dict(line.split("\t") for line in open(tmp_path / "out" / "matching_results.tsv").read().splitlines()[1:])
    assert len(rows) == len(names) and sum(f"S2-{k[3:]}" in v for k, v in rows.items()) > 0.9 * len(names) and not any("S3-" in v for v in rows.values())


def test_command_line(spark, files, tmp_path, capsys):
    assert cli.main(["index", "--source2", files["source2"], "--source3", files["source3"], "--folder", str(tmp_path)]) == 0
    assert cli.main(["retrieve", "--source1", files["source1"], "--manifest", f"{tmp_path}/manifest.json", "--output", str(tmp_path / "out"), "--threshold", "0.9"]) == 0
    out = [str(tmp_path / "out" / n) for n in ("matching_results.tsv", "candidate_pairs.tsv")]
    assert cli.main(["validate", "--source1", files["source1"], "--matches", out[0], "--candidates", out[1]]) == 0
    assert cli.main(["evaluate", "--truth", files["truth"], "--matches", out[0]]) == 0
    assert "macro_f_half" in capsys.readouterr().out
    assert cli.main(["bench", *[x for k in ("source1", "source2", "source3", "truth") for x in (f"--{k}", files[k])], "--folder", str(tmp_path / "b")]) == 0
    assert "edge_recall: 1.0000" in capsys.readouterr().out
    assert cli.main(["generate", "--records", "20", "--folder", str(tmp_path / "gen")]) == 0
    with pytest.raises(SystemExit):
        cli.main(["unknown"])


def test_stream_equals_batch(spark, files, tmp_path):
    corpus = text.normalize(tsv.read_source(spark, files["source2"], "S2-"))
    index = retrieval.build(corpus)
    folder = tmp_path / "incoming"
    folder.mkdir()
    lines = open(files["source1"]).read().splitlines(keepends=True)
    _write(folder / "a.tsv", "".join(lines[1:5]))
    run = lambda: streaming.start(streaming.stream_sources(spark, str(folder)), index, str(tmp_path / "pairs"), str(tmp_path / "check")).awaitTermination()
    run()
    _write(folder / "b.tsv", "".join(lines[5:]))
    run()
    run()
    got = {r["s1"]: r["ids"] for r in spark.read.parquet(str(tmp_path / "pairs")).collect()}
    queries = text.normalize(tsv.read_source(spark, files["source1"], "S1-"))
    want = {r["s1"]: r["ids"] for r in retrieval.groups(queries, retrieval.candidates(queries, index, RetrievalConfig())).collect()}
    assert got == want and len(got) == 10


def test_sample(spark):
    made = generate.scale_data(spark, 100)
    corpus = made["source2"].unionByName(made["source3"])
    sample = generate.representative_sample(made["source1"], corpus, made["truth"], 5, 20)
    assert (sample["source1"].count(), sample["source2"].count(), sample["source3"].count(), sample["truth"].count()) == (5, 10, 10, 5)
    linked = sample["truth"].select(F.explode("matched_entity_ids").alias("entity_id"))
    assert linked.join(sample["source2"].unionByName(sample["source3"]), "entity_id", "left_anti").count() == 0
    with pytest.raises(ValueError):
        generate.representative_sample(made["source1"], corpus, made["truth"], 50)
