import gzip
import hashlib

import pytest

from brookmart.llm import warc
from brookmart.llm.common import folder
from brookmart.llm.records import file_system


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.001/pages.parquet")


def read_all(target, index):
    system, root = file_system(target)
    out = {}
    for r in index.collect():
        with system.open_input_file(f"{root}/{r.file}") as f:
            out[r.file, r.at] = f.read_at(r.length, r.offset)
    return out


def test_files_hold_the_pages(spark, pages):
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (None, "http://x\r\ny", "<p>é</p>"), (2, "", "z" * 300_000)],
                                "page_id long, url string, html string").selectExpr("*", "1 AS file", "'x' AS sha256")
    for frame in (pages, odd):
        target = folder(spark, "test-warc")
        index = warc.write_warc(frame, target)
        data = read_all(target, index)
        rows = index.orderBy("file", "at").collect()
        texts = sorted(r.html or "" for r in frame.collect())
        found, end, last = [], {}, None
        for r in rows:
            assert r.offset == end.get(r.file, 0)
            end[r.file] = r.offset + r.length
            raw = gzip.decompress(data[r.file, r.at])
            head, _, block = raw.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and f"sha256:{r.payload_sha256}".encode() in head
            body = block.partition(b"\r\n\r\n")[2][:-4]
            assert hashlib.sha256(body).hexdigest() == r.payload_sha256 and len(body) == r.payload_bytes
            found.append(body.decode())
            # in ascending order within a file, null ids first
            assert last is None or last[0] != r.file or last[1] is None or r.page_id >= last[1]
            last = r.file, r.page_id
        assert sorted(found) == texts


@pytest.mark.parametrize("fanout", [2, 16])
def test_audit_finds_just_what_is_damaged(spark, pages, fanout):
    source, replica = folder(spark, "source"), folder(spark, "replica")
    index = warc.write_warc(pages.repartition(3), source)
    assert warc.replicate(index, source, replica) == index.select("file").distinct().count()
    assert warc.audit(index, replica, fanout).filter("damaged").count() == 0
    broken = folder(spark, "broken")
    warc.replicate(index, source, broken, warc.flip)
    got = warc.audit(index, broken, fanout).collect()
    assert len(got) == pages.count()
    assert {r.page_id for r in got if r.damaged} == {r.page_id for r in got if r.page_id % 50 == 0}


def test_lost_and_cut_files(spark, pages):
    source, replica = folder(spark, "source"), folder(spark, "replica")
    index = warc.write_warc(pages, source)
    warc.replicate(index, source, replica)
    last = index.orderBy("file", "at").collect()[-1]
    system, root = file_system(replica)
    with system.open_input_file(f"{root}/{last.file}") as f:
        data = f.read()
    with system.open_output_stream(f"{root}/{last.file}", compression=None) as f:
        f.write(data[:-1])
    assert [(r.file, r.at) for r in warc.audit(index, replica).filter("damaged").collect()] == [(last.file, last.at)]
    nowhere = folder(spark, "nowhere")
    assert warc.audit(index, nowhere).filter("damaged").count() == index.count()


def test_surplus_bytes_and_files_are_found(spark, pages):
    source, replica = folder(spark, "source"), folder(spark, "replica")
    index = warc.write_warc(pages.repartition(3), source)
    warc.replicate(index, source, replica)
    assert warc.audit_files(index, replica).filter("damaged").count() == 0
    system, root = file_system(replica)
    names = sorted(r.file for r in index.select("file").distinct().collect())
    with system.open_input_file(f"{root}/{names[0]}") as f:
        data = f.read()
    for name, what in ((names[0], data + b"surplus"), ("foreign", b"x")):
        with system.open_output_stream(f"{root}/{name}", compression=None) as f:
            f.write(what)
    found = {r.file: (r.meant_bytes, r.real_bytes, r.n_damaged) for r in warc.audit_files(index, replica).filter("damaged").collect()}
    assert found == {names[0]: (len(data), len(data) + 7, 0), "foreign": (None, 1, 0)}
    # the root differs, though no record does
    one = warc.tree(index, 16, warc.meant_sizes(index))[-1].first().hash
    assert one != warc.tree(warc.read_hashes(index, replica), 16, warc.real_sizes(spark, replica))[-1].first().hash
    lost = warc.audit_files(index, folder(spark, "nowhere")).collect()
    assert {(r.real_bytes, r.damaged) for r in lost} == {(None, True)} and len(lost) == len(names)


def test_only_differing_branches_are_descended(spark, pages):
    source, replica = folder(spark, "source"), folder(spark, "replica")
    index = warc.write_warc(pages.coalesce(1), source)
    warc.replicate(index, source, replica, warc.flip)
    one, other = (warc.tree(x, 4) for x in (index.select("file", "at", "offset", "length", "sha256"),
                                            warc.read_hashes(index, replica)))
    assert one[-1].count() == 1 and one[-1].first().hash != other[-1].first().hash
    # a level below the damage that no branch leads to is not looked at
    clean = [level if i else level.filter("node % 1 = 0") for i, level in enumerate(one)]
    assert warc.differing(clean, clean, 4).count() == 0


def test_nothing(pages):
    assert warc.damaged_replica(pages.limit(0)).count() == 0
