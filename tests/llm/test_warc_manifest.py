import os
from pathlib import Path

import pytest

from loam.llm import warc


def test_a_file_that_the_manifest_names_must_be_there(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h.org/{k}", f"page {k} " * 50) for k in range(40)], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, f"file://{tmp_path}/out", shard_bytes=4000)
    names = sorted(r.file for r in manifest.collect())
    assert len(names) > 1 and warc.read_archives(spark, f"file://{tmp_path}/out").count() == 40
    os.remove(next(Path(tmp_path / "out").rglob(names[0])))
    with pytest.raises(ValueError, match=names[0]):
        warc.read_archives(spark, f"file://{tmp_path}/out").count()
