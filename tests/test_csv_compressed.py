"""CSV drops with compressed files."""

from __future__ import annotations

import gzip

from kalendra.sources import csv_drop


def test_compressed_files_of_a_drop_are_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as file:
        file.write('x,y,z\n1,"2\n3",4\n5,6,7\n')
    (tmp_path / "c.txt").write_text("x\n")
    cells = csv_drop.read_cells(spark, str(tmp_path))
    found = sorted((r.file.rsplit("/", 1)[1], r.line_no, r.cells) for r in cells.collect())
    assert found == [
        ("a.csv", 0, ["x", "y"]), ("a.csv", 1, ["1", "2"]), ("b.csv.gz", 2, ["x", "y", "z"]),
        ("b.csv.gz", 3, ["1", "2\n3", "4"]), ("b.csv.gz", 4, ["5", "6", "7"]),
    ]
