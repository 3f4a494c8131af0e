"""One large annotation file against a reading of it as a whole."""

import json

import numpy as np
import pytest

from lodestar.sources import readers


def catalogue(n, seed):
    rng = np.random.default_rng(seed)
    odd = ['a}b{', '"quoted" \\ and ]', "line\nend}", "[{", "é日\U0001f600", "\\\"}", "}" * 50, ""]
    images = [{"id": i, "file_name": odd[i % 8] * int(rng.integers(0, 9)), "width": int(rng.integers(1, 900)), "height": 5, "extra": {"x": [1, {"y": "]}"}]}} for i in range(n)]
    notes = [{"id": i, "image_id": int(rng.integers(0, n)), "category_id": i % 7, "bbox": [float(v) for v in rng.integers(0, 99, 4)],
              "segmentation": [[float(v) for v in rng.integers(0, 9, int(rng.integers(0, 60)))]], "note": odd[i % 8]} for i in range(n)]
    notes[n // 2]["note"] = "} { " * 30000  # an object over several splits
    return {"info": {"list": [{"id": "not a row}"}], "about": "x"}, "licenses": [{"id": 1}], "images": images, "annotations": notes,
            "categories": [{"id": 1, "name": "c}", "supercategory": None}], "none": [], "end": "]}"}


@pytest.mark.parametrize("indent", [None, 2])
def test_a_file_split_at_its_objects(spark, tmp_path, indent):
    made = [catalogue(1500, 1), catalogue(40, 2)]
    for i, c in enumerate(made):
        (tmp_path / f"{i}.json").write_text(json.dumps(c, indent=indent, ensure_ascii=i == 0), encoding="utf-8")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        t = readers.read_annotations(spark, str(tmp_path), multi_line=True)
        assert t["images"].rdd.getNumPartitions() > 10
        rows = {k: sorted(map(tuple, v.collect()), key=repr) for k, v in t.items()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = {"images": [(r["id"], r["file_name"], r["width"], r["height"]) for c in made for r in c["images"]],
            "annotations": [(r["id"], r["image_id"], r["category_id"], *map(int, r["bbox"])) for c in made for r in c["annotations"]],
            "categories": [(1, "c}", None)] * 2}
    assert rows == {k: sorted(v, key=repr) for k, v in want.items()}


def test_an_empty_object(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"images": [], "annotations": []}')
    t = readers.read_annotations(spark, str(tmp_path / "a.json"), multi_line=True)
    assert [v.count() for v in t.values()] == [0, 0, 0]
