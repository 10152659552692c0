"""Files taken as they come, each once, whatever ends the job in between."""

import pytest
from helpers import arrivals, rows_of
from pyspark.errors import StreamingQueryException

from starmart.plans import incoming
from starmart.sources import Publication, read_manifest, read_published, write_table


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        files, output, checkpoint = (str(tmp_path / n) for n in ("incoming", "output", "checkpoint"))

        def bring(self, *changes):
            arrivals(spark, *changes).coalesce(1).write.mode("append").parquet(self.files)

        def take(self, **options):
            return incoming.take_arrivals(spark, self.files, self.output, checkpoint=self.checkpoint, **options)

        def rows(self):
            return rows_of(read_published(spark, self.output, "immigration").select("month", "cicid"))

    return Place()


def test_a_file_is_taken_once(spark, place):
    place.bring({"cicid": 1.0}, {"cicid": 2.0, "i94mon": 5.0})
    assert place.take(add=True) == 1
    assert place.take(add=True) == 0
    place.bring({"cicid": 3.0})
    place.bring({"cicid": 4.0, "i94mon": 6.0})
    assert place.take(add=True, files_per_batch=1) == 2
    assert place.rows() == [(4, 1), (4, 3), (5, 2), (6, 4)]


def test_a_batch_replaces_the_months_it_brings(spark, place):
    place.bring({"cicid": 1.0}, {"cicid": 2.0, "i94mon": 5.0})
    place.take()
    place.bring({"cicid": 3.0})
    place.take()
    assert place.rows() == [(4, 3), (5, 2)]


def test_other_tables_stay(spark, place):
    with Publication(spark, place.output) as new:
        write_table(spark.range(3), new.folder("list"))
        new.add("list", spark.range(3).schema)
        new.complete({"other": 7})
    place.bring({"cicid": 1.0})
    place.take()
    assert read_published(spark, place.output, "list").count() == 3
    assert read_manifest(spark, place.output).marks["other"] == 7


@pytest.mark.parametrize("add", [False, True])
@pytest.mark.parametrize("published", [False, True])
def test_a_job_that_ends_between_batch_and_commit(spark, place, monkeypatch, add, published):
    """The log does not know that the batch was done; the manifest does."""
    place.bring({"cicid": 1.0})
    place.take(add=add)
    place.bring({"cicid": 2.0})
    complete = Publication.complete

    def ended(self, marks=None):
        if published:
            complete(self, marks)
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patched:
        patched.setattr(Publication, "complete", ended)
        with pytest.raises(StreamingQueryException, match="the driver is gone"):
            place.take(add=add)
    after = [(4, 1), (4, 2)] if add else [(4, 2)]
    assert place.rows() == (after if published else [(4, 1)])
    assert place.take(add=add) == (0 if published else 1)
    assert place.rows() == after
    place.bring({"cicid": 9.0, "i94mon": 9.0})
    assert place.take(add=add) == 1
    assert place.rows() == [*after, (9, 9)]


def test_a_batch_that_fails_its_checks_is_given_out_again(spark, place):
    place.bring({"cicid": 1.0})
    place.take()
    place.bring({"i94yr": None})
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="null_count"):
            place.take()
    assert place.rows() == [(4, 1)]


def test_nothing_there_is_nothing_to_do(spark, place, tmp_path):
    (tmp_path / "incoming").mkdir()
    assert place.take() == 0
    assert read_manifest(spark, place.output) is None
