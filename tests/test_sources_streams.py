"""Readers, writers and streams on files made here."""

from __future__ import annotations

import gzip
import json

from pyspark.sql import functions as F

from quorumtext.sources import readers, sinks
from quorumtext.streaming import decisions


def test_readers(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p/1.json").write_text(json.dumps({"pdf_page": 1, "words": [{"text": "a", "tier": "unanimous", "bbox": [0.1, 0.2, 0.3, 0.4]}, {"text": "b", "tier": "contested", "bbox": [0, 0, 1, 1], "variants": ["c"]}]}, indent=1))
    got = readers.words(spark, str(tmp_path / "p/*.json")).orderBy("idx").collect()
    assert [(r["idx"], r["text"], round(r["x0"], 1)) for r in got] == [(0, "a", 0.1), (1, "b", 0.0)]
    (tmp_path / "t.tsv").write_text("# c\nid\ttext\n1\tone\n2\n\n")
    assert [tuple(r) for r in readers.truth(spark, str(tmp_path / "t.tsv")).orderBy("id").collect()] == [("1", "one"), ("2", "")]
    (tmp_path / "d.tsv").write_text("A\tx\nA\ty\nB\t\n")
    assert {r["key"]: r["value"] for r in readers.dictionary(spark, str(tmp_path / "d.tsv")).collect()} == {"A": "y", "B": None}
    (tmp_path / "e.jsonl").write_text('# log\n{"leaf": 1, "anchor": "a", "op": "drop"}\n{"leaf": 1, "anchor": "a", "op": "date"}\n')
    assert readers.edits(spark, str(tmp_path / "e.jsonl"), "leaf int, anchor string, op string").first()["op"] == "date"
    (tmp_path / "o.tsv").write_text("level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n5\t1\t1\t1\t1\t1\t10\t20\t30\t40\t90\t\"q\n4\t1\t1\t1\t1\t0\t0\t0\t0\t0\t-1\t\n")
    row = readers.ocr_words(spark, str(tmp_path / "o.tsv"), 100, 100).first()
    assert (row["text"], row["x1"], row["y1"]) == ('"q', 0.4, 0.6)
    with gzip.open(tmp_path / "h.html.gz", "wt") as f:
        f.write("<div class='ocr_page'>\n<span class='ocr_line'>\n<span class='ocrx_word' title='bbox 1 2 3 4'>uno</span>\n<span class='ocrx_word' title='bbox 5 6 7 8'>dos</span>\n")
    rows = readers.hocr_words(spark, str(tmp_path / "h.html.gz"))
    assert readers.grouped_lines(rows, ["page", "line"], "n").first()["text"] == "uno dos"
    inventory = spark.createDataFrame([(1, "body"), (2, "blank"), (4, "body")], "pdf_page int, section string")
    assert [r[0] for r in readers.targets(inventory, "every:2").select("pdf_page").collect()] == [4]
    flipped = readers.adapted("e", spark.createDataFrame([(1, "t", 10.0, 10.0, 20.0, 30.0)], "pdf_page int, text string, x0 double, y0 double, x1 double, y1 double"), F.lit(100.0), F.lit(100.0), True).first()
    assert (round(flipped["y0"], 2), round(flipped["y1"], 2)) == (0.7, 0.9)


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b"), (1, None)], "id int, text string")
    sinks.write_truth(rows, str(tmp_path / "t"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))) == "1\t\n2\tb\n"
    sinks.write_pages(rows.withColumn("pdf_page", F.col("id")), str(tmp_path / "pages"))
    assert len(list((tmp_path / "pages").glob("pdf_page=*"))) == 2
    new = spark.createDataFrame([(2, "z")], "id int, text string")
    assert sorted(map(tuple, sinks.replace_keys(rows, new, ["id"]).collect())) == [(1, None), (2, "z")]
    assert rows.select(sinks.search_payload(rows, "id", "id", "text").alias("j")).first()["j"] == '["2","2","b"]'


def test_streams(spark, tmp_path):
    folder, schema = tmp_path / "in", "key string, seq int, chose string"
    folder.mkdir()
    (folder / "1.json").write_text('{"key": "a", "seq": 1, "chose": "x"}\n{"key": "b", "seq": 2, "chose": "y"}\n')
    target = tmp_path / "out"

    def go():
        q = decisions.keep_latest(decisions.read_decisions(spark, str(folder), schema), ["key"], "seq", str(target), str(tmp_path / "ck"))
        q.awaitTermination()

    go()
    (folder / "2.json").write_text('{"key": "a", "seq": 3, "chose": "z"}\n')
    go()
    last = max(target.iterdir(), key=lambda p: int(p.name[1:]))
    assert {r["key"]: r["chose"] for r in spark.read.parquet(str(last)).collect()} == {"a": "z", "b": "y"}
    queue = spark.createDataFrame([("a",), ("c",)], "key string")
    assert [r[0] for r in decisions.open_queue(queue, spark.read.parquet(str(last)), ["key"]).collect()] == ["c"]
