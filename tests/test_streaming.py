import os
import shutil
import tempfile

from tablesync.session import work_dir
from tablesync.streaming import file_copy as FC


def test_file_copy_is_incremental(spark):
    src = tempfile.mkdtemp(prefix="tablesync-src-")
    os.makedirs(os.path.join(src, "sub folder"))
    shutil.copy("/root/testdata/sf0.001/region.parquet", os.path.join(src, "region.parquet"))
    shutil.copy("/root/testdata/sf0.001/nation.parquet", os.path.join(src, "sub folder", "it's nation.parquet"))
    root = work_dir(spark, "test_stream")
    cfg = FC.VolumeCopy(src, root + "/dst", root + "/log", root + "/ckpt", timeout_seconds=300)
    FC.copy_volume(spark, cfg, "a")
    log = FC.read_log(spark, cfg.log_path)
    assert log.count() == 2 and {r["status"] for r in log.collect()} == {"success"}
    local_root = root[len("file:"):] if root.startswith("file:") else root
    assert os.path.exists(os.path.join(local_root + "/dst", "sub folder", "it's nation.parquet"))
    FC.copy_volume(spark, cfg, "b")
    assert FC.read_log(spark, cfg.log_path).count() == 2
    shutil.copy("/root/testdata/sf0.001/customer.parquet", os.path.join(src, "customer.parquet"))
    FC.copy_volume(spark, cfg, "c")
    log = FC.read_log(spark, cfg.log_path)
    assert log.count() == 3 and log.where("run_id = 'c'").count() == 1
    # rescan: fresh checkpoint, every file again
    FC.copy_volume(spark, FC.VolumeCopy(src, root + "/dst", root + "/log", root + "/ckpt", mode="rescan"), "d")
    assert FC.read_log(spark, cfg.log_path).where("run_id = 'd'").count() == 3
    stats = {r["run_id"]: (r["total_files"], r["error_files"], r["status"]) for r in FC.copy_stats(FC.read_log(spark, cfg.log_path), ("run_id",)).collect()}
    assert stats == {"a": (2, 0, "success"), "c": (1, 0, "success"), "d": (3, 0, "success")}


def test_copy_errors_are_rows_not_failures(spark):
    files = spark.createDataFrame([("file:/nonexistent/x.bin", None, 3)], "path string, modificationTime timestamp, length long")
    out = FC.copy_batch(files, "file:/nonexistent", work_dir(spark, "err")).collect()
    assert len(out) == 1 and out[0]["status"] == "error" and out[0]["error_msg"]


def test_crc_of_parts():
    import random
    import zlib

    from tablesync.streaming.split_copy import combined

    r = random.Random(1)
    for _ in range(50):
        data = r.randbytes(r.randrange(5000))
        cuts = sorted(r.randrange(len(data) + 1) for _ in range(r.randrange(6)))
        parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
        assert combined([(len(p), zlib.crc32(p)) for p in parts]) == zlib.crc32(data)


def test_large_files_are_copied_in_parts(spark, tmp_path, monkeypatch):
    import zlib

    import tablesync.streaming.split_copy as SC

    src, dst = tmp_path / "src", tmp_path / "dst"
    (src / "deep").mkdir(parents=True)
    files = {"a.bin": bytes(range(256)) * 400, "deep/it's b.bin": b"x" * 1000, "empty.bin": b"", "one.bin": b"1"}
    for name, data in files.items():
        (src / name).write_bytes(data)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(src)).select("path", "modificationTime", "length")
    # the scan lists no empty files; the copy takes them
    empty = listed.limit(1).selectExpr(f"'{src}/empty.bin' as path", "modificationTime", "0L as length")
    listed = spark.createDataFrame(listed.unionByName(empty).collect(), listed.schema)
    plan = SC.file_parts(listed, 1000)
    assert plan.count() == 103 + 1 + 1 + 1 and plan.agg({"size": "max"}).first()[0] == 1000
    monkeypatch.setattr(SC, "CHUNK", 300)
    for mounted in (True, False):
        if not mounted:  # ranges as files of their own, strung together
            monkeypatch.setattr(SC, "_mounted", lambda target: False)
        out = {r["source_path"].split("/src/")[1]: r for r in SC.copy_files(listed, str(src), str(dst / str(mounted)), 1000).collect()}
        for name, data in files.items():
            row = out[name.replace("'", "%27").replace(" ", "%20")] if name not in out else out[name]
            assert row["status"] == "success" and row["crc32"] == zlib.crc32(data), row
            assert (dst / str(mounted) / name).read_bytes() == data
        assert not [p for p in (dst / str(mounted)).rglob(".tablesync*")]


def test_a_file_that_changed_or_went_fails_alone(spark, tmp_path):
    import tablesync.streaming.split_copy as SC

    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    for name in ("good", "gone", "short"):
        (src / name).write_bytes(b"z" * 5000)
    listed = spark.read.format("binaryFile").load(str(src)).select("path", "modificationTime", "length")
    listed = spark.createDataFrame(listed.collect(), "path string, modificationTime timestamp, length long")
    (src / "gone").unlink()
    (src / "short").write_bytes(b"z" * 3000)
    out = {r["source_path"].rsplit("/", 1)[1]: r for r in SC.copy_files(listed, str(src), str(dst), 1000).collect()}
    assert out["good"]["status"] == "success" and (dst / "good").read_bytes() == b"z" * 5000
    assert out["gone"]["status"] == out["short"]["status"] == "error" and "ends before" in out["short"]["error_msg"]
    assert not (dst / "gone").exists() and not (dst / "short").exists() and out["short"]["crc32"] is None
