"""A delivery arrives in as many files as keep each in bounds, and gives the same points."""

import glob

from farsight.plans import queries as Q


def test_files_of_a_delivery_are_bounded(spark, monkeypatch):
    folder, arriving, make = "/root/testdata/sf0.001", [], Q.fresh_folder

    def noted(spark, purpose):
        made = make(spark, purpose)
        if purpose == "arriving":
            arriving.append(made)
        return made

    monkeypatch.setattr(Q, "fresh_folder", noted)
    few = sorted(map(str, Q.stream_ingest(spark, folder).collect()))
    monkeypatch.setattr(Q, "FILE_BYTES", 60_000)
    many = sorted(map(str, Q.stream_ingest(spark, folder).collect()))
    assert few == many
    files = [len(glob.glob(f"{made.removeprefix('file:')}/*.parquet")) for made in arriving]
    assert files[0] <= 6 < files[1]
