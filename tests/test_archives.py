"""Archives that cannot be used, the raster data source, and stages that are let go."""

import numpy as np
import pytest

from tessella.operators import tiles as R
from tessella.plans import images as I
from tessella.runtime import Stages, shared_folder
from tessella.sources import archives as A
from tessella.sources import planned
from tessella.sources.rasters import scan_folder
from tests.test_tiles import archive, npy

RNG = np.random.default_rng(4)
GOOD = RNG.integers(0, 256, (20, 40, 4), dtype=np.uint8)
BAD = {
    "broken.zip": (archive(x_npy=npy(GOOD))[:300], "not a zip archive"),
    "empty.zip": (b"", "not a zip archive"),
    "none.zip": (archive(notes_txt=b"no image"), "no member with the suffix"),
    "garbage.zip": (archive(x_npy=b"\x93NUMPY?"), "does not decode"),
    "wide-cells.zip": (archive(x_npy=npy(GOOD.astype(np.uint16))), "not uint8 rows x columns x channels"),
    "flat.zip": (archive(x_npy=npy(GOOD[..., 0])), "not uint8 rows x columns x channels"),
    "three.zip": (archive(x_npy=npy(GOOD[..., :3])), "too few channels"),
    "odd.zip": (archive(x_npy=npy(GOOD[:13])), "does not fit the tiles or blocks"),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("mixed")
    for name in ("a.zip", "_hidden.zip", ".dot.zip"):
        (path / name).write_bytes(archive(x_npy=npy(GOOD)))
    for name, (data, _) in BAD.items():
        (path / name).write_bytes(data)
    (path / "other.txt").write_bytes(b"not an archive")
    (path / "sub").mkdir()
    return str(path)


def test_bad_archives_are_rows_of_the_same_scan(spark, folder):
    scan = R.scan_archives(A.archive_bytes(spark, folder), (5, 2), 10, A.decode_npy, ".npy").cache()
    assert {r.file_name: r.reason for r in R.rejects_of_scan(scan).collect()} == {n: why for n, (_, why) in BAD.items()}
    features = R.features_of_scan(scan).collect()
    assert len(features) == 48 and {r.tile_id.rsplit("-", 1)[0] for r in features} == {"a.zip", "_hidden.zip", ".dot.zip"}
    assert all((r.reason is None) != (r.tile_id is None) for r in scan.collect())


def test_blocks_that_do_not_fit_reject_the_image(spark, folder):
    scan = R.scan_archives(A.archive_bytes(spark, folder), (5, 3), 10, A.decode_npy, ".npy")
    assert R.features_of_scan(scan).count() == 0
    assert R.rejects_of_scan(scan).where("file_name = 'a.zip' AND detail LIKE '%3x3%'").count() == 1


def test_the_data_source_sees_what_the_scan_sees(spark, folder):
    found = scan_folder(spark, folder, (5, 2), 10, "npy", ".npy").cache()
    scan = R.scan_archives(A.archive_bytes(spark, folder), (5, 2), 10, A.decode_npy, ".npy")
    key = lambda r: (r.file_name, r.reason, r.tile_id, r.block, r.features)
    rows = found.collect()
    assert sorted(map(str, map(key, rows))) == sorted(map(str, map(key, scan.collect())))
    assert len(rows) == 48 + len(BAD)


def test_archives_are_dealt_by_size(spark, folder):
    files = [planned.File(f"/x/{i}", str(i), s) for i, s in enumerate([50 << 20, 1, 2, 300 << 20, 60 << 20, 3])]
    parts = planned.deal(files, 128 << 20)
    assert sorted(f.name for p in parts for f in p.files) == list("012345")
    assert all(sum(f.size + planned.OPEN_COST for f in p.files) <= 128 << 20 or len(p.files) == 1 for p in parts)
    assert len(parts) == 3
    spark.conf.set("spark.sql.files.maxPartitionBytes", str((4 << 20) + 2000))
    try:
        assert scan_folder(spark, folder, (5,), 10, "npy", ".npy").rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_an_empty_folder_gives_no_rows(spark, tmp_path):
    assert scan_folder(spark, str(tmp_path), (5,), 10, "npy").collect() == []


def test_a_missing_decoder_fails_loudly(spark, folder):
    with pytest.raises(Exception, match="no_such_package"):
        scan_folder(spark, folder, decoder="no_such_package:decode").collect()

    def decode(data):
        import no_such_package  # noqa: F401

    scan = R.scan_archives(A.archive_bytes(spark, folder), (5,), 10, decode, ".npy")
    with pytest.raises(Exception, match="no_such_package"):
        scan.collect()
    with pytest.raises(Exception, match="no_such_package"):
        A.read_rasters(A.archive_bytes(spark, folder), decode, ".npy").collect()


def test_tiles_tell_why_a_raster_has_none(spark, folder):
    rasters = A.read_rasters(A.archive_bytes(spark, folder), A.decode_npy, ".npy")
    rows = R.tile_raster(rasters, 10, rejects=True).collect()
    assert {r.image: r.reason for r in rows if r.reason} == {n: w for n, (_, w) in BAD.items() if w != "too few channels"}
    assert sum(r.image in ("a.zip", "three.zip") for r in rows) == 16 and len(rows) == 32 + len(BAD) - 1
    with pytest.raises(Exception, match="cannot be cut"):
        R.tile_raster(rasters, 10).collect()


@pytest.mark.parametrize("decode", [A.decode_npy, "npy"])
def test_the_job_stops_or_lists_what_it_left_out(spark, folder, tmp_path, decode):
    args = dict(blocks=(2,), tile=10, settings=I.Settings(m=16, b=2, n_sample=5), decode=decode, suffix=".npy")
    with pytest.raises(I.ArchivesRejected, match="broken.zip: not a zip archive"):
        I.similar_images(spark, folder, ["a.zip-0"], **args)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    rows = I.similar_images(spark, folder, ["a.zip-0"], rejects=str(tmp_path / "rejects"), **args).collect()
    assert rows[0].tile_id.endswith("zip-0") and rows[0].distance == 0
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == len(BAD)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_every_regular_file_counts(spark, tmp_path):
    from tessella.plans.blog import blog_industry_mentions
    from tessella.sources import files

    post = "<Blog><date>1,May,2004</date><post>\r\nlaw and Arts\r\n</post></Blog>"
    for name in ("1.m.2.arts.x.xml", "_1.m.2.law.x.xml", ".2.m.2.none.x.xml"):
        (tmp_path / name).write_text(post, newline="")
    (tmp_path / "3.m.2.empty.x.xml").write_text("")
    (tmp_path / "folder").mkdir()
    names = {p.name for p in tmp_path.iterdir() if p.is_file()}
    assert {r.file_name for r in files.list_files(spark, str(tmp_path)).collect()} == names
    assert {r.file_name: r.content for r in files.read_whole_text(spark, str(tmp_path)).collect()} == {
        n: "" if "empty" in n else post for n in names
    }
    assert {r.file_name for r in files.read_binary(spark, f"file:{tmp_path}").collect()} == names
    assert {r.file_name for r in files.read_whole_text(spark, f"{tmp_path}/*law*").collect()} == {"_1.m.2.law.x.xml"}
    for whole in (False, True):
        rows = blog_industry_mentions(spark, str(tmp_path), whole_files=whole, grouped=False).collect()
        assert sorted((r.year_month, r.term, r.n) for r in rows) == [("2004-May", "arts", 3), ("2004-May", "law", 3)]


def test_stages_are_let_go(spark):
    from pathlib import Path

    with Stages(spark) as stages:
        kept, stored = stages.keep(spark.range(5)), stages.write(spark.range(7), "some")
        assert kept.count() == 5 and stored.count() == 7 and kept.is_cached
        folders = list(Path(shared_folder(spark)).glob("some-*"))
        assert len(folders) == 1
    assert not kept.is_cached and not folders[0].exists()
