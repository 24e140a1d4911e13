import json

import pytest

from pitchline.sources import files, ledger
from pitchline.shared import new_folder


def load(spark, urls, get, **more):
    spark.dataSource.register(files.download_source(get, **more))
    rows = spark.read.format("downloads").option("urls", json.dumps(urls)).load().collect()
    return {r.url: (r.status, r.error, r.attempts) for r in rows}


@pytest.mark.parametrize("retries, want", [(0, (None, "down", 1)), (1, (503, "HTTP 503", 2)), (2, (200, None, 3)), (5, (200, None, 3))])
def test_downloads_are_tried_again_a_bounded_number_of_times(spark, tmp_path, retries, want):
    log = str(tmp_path / "asked")

    def get(url, accept):  # fails on the way, then on the other side, then works
        with open(log, "a+") as f:
            f.write(".")
            f.seek(0)
            n = len(f.read())
        if n == 1:
            raise OSError("down")
        return (503, b"") if n == 2 else (200, b"body")

    assert load(spark, ["u"], get, retries=retries) == {"u": want}


def test_what_cannot_be_mended_is_not_tried_again(spark):
    assert load(spark, ["a", "b"], lambda url, accept: (404, b"") if url == "a" else (200, b""), retries=3) == {"a": (404, "HTTP 404", 1), "b": (200, None, 1)}


def test_ledger(spark):
    book = ledger.Ledger(spark, new_folder(spark, "ledger"))
    assert book.done("s").count() == 0
    add = lambda *rows: book.add(spark.createDataFrame([("s", p, f"u/{p}", place, "t", 1, 200 if ok else None, None if ok else "down", 1) for p, place, ok in rows], ledger.SCHEMA))
    add(("a", 0, True), ("b", 1, False))
    add(("b", 1, True), ("a", 0, True))
    assert sorted(tuple(r) for r in book.done("s").collect()) == [("a", 0, "u/a"), ("b", 1, "u/b")] and book.done("t").count() == 0
    assert book.rows().count() == 4
