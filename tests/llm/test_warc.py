import hashlib
import uuid

from helpers import rows

from cityviews.llm.warc import place, read_archives, write_archives

SCHEMA = "page_id long, url string, html string, member string, size string, refers_to string"


def pages():
    big = "<p>" + "word " * 200_000
    data = [(i, f"http://x/{i}", f"<p>page {i} " + "é" * 60) for i in range(30)]
    data += [(100 - i, "http://y z/\r\n", "same " * 40) for i in range(20)]
    data += [(200, None, None), (201, "u", ""), (202, "u", "short"), (203, "u", "short"), (204, "u", big),
             (205, "u", big), (None, "u", "same " * 40), (None, None, "alone " * 50), (7, "u", "<p>other"),
             (206, "u", "WARC/1.1\r\n\r\n" * 20), (81, "http://y", "same " * 40)]
    return data


def brute(data):
    first = {}
    for i, _, text in data:
        p = (text or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, text in data:
        p = (text or "").encode()
        head = first.get(p)
        again = len(p) >= 100 and head is not None and i != head
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response",
                    head if again else None))
    return sorted(out, key=repr)


def test_round_trip_and_equal_files(spark, tmp_path):
    manifests = []
    for parts in (1, 6):
        folder = f"file:{tmp_path}/{uuid.uuid4().hex}"
        df = spark.createDataFrame([(*x, "a", "b", "c") for x in pages()], SCHEMA).repartition(parts)
        made = rows(write_archives(df, folder, file_bytes=1500))
        manifests.append(made)
        assert rows(read_archives(spark, folder)) == brute(pages())
        system, path = place(folder)
        for name, _, size, digest in made:
            data = system.open_input_file(f"{path}/{name}").read()
            assert len(data) == size and hashlib.sha256(data).hexdigest() == digest
    assert manifests[0] == manifests[1] and len(manifests[0]) > 3


def test_files_outside_the_manifest_do_not_count(spark, tmp_path):
    folder = str(tmp_path / "w")
    df = spark.createDataFrame([(1, "u", "x" * 200)], "page_id long, url string, html string")
    write_archives(df, folder)
    (tmp_path / "w" / "pages-99999999-0000.warc.gz").write_bytes(b"half a file")
    assert read_archives(spark, folder).count() == 1


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "e")
    write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert read_archives(spark, folder).count() == 0
