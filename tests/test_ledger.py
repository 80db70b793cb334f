"""Delivery with a ledger: transports that fail, runs that die, repeats."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from rowloom import dead_letters, deliver_once, render_requests


def outbox(folder, fails):
    """A transport that keeps each request as a file and fails where it is told to."""

    def send(request):
        number = int(request["url"].rsplit("/", 1)[1])
        if fails(number):
            raise OSError(f"no answer for {number}")
        with open(os.path.join(folder, f"{number}-{uuid.uuid4().hex}"), "w") as file:
            file.write(request["headers"]["Idempotency-Key"])

    return send


def sent(folder):
    names = [os.path.basename(path) for path in glob.glob(f"{folder}/*")]
    return sorted(int(name.split("-")[0]) for name in names)


def requests_of(spark, count, copies=1):
    rows = spark.range(0, count, 1, 3).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    return render_requests(rows, "https://api.example.com/{{ id }}", body_template='{"n": {{ id }}}')


@pytest.fixture
def places(tmp_path):
    os.mkdir(tmp_path / "out")
    return str(tmp_path / "out"), str(tmp_path / "ledger")


def test_second_run_sends_what_failed(spark, places):
    folder, ledger = places
    requests = requests_of(spark, 40, copies=3)
    first = deliver_once(requests, outbox(folder, lambda n: n % 2 == 1), ledger)
    assert {(r.status, r["count"]) for r in first.groupBy("status").count().collect()} == {("delivered", 20), ("failed", 20)}
    assert sent(folder) == list(range(0, 40, 2))
    second = deliver_once(requests, outbox(folder, lambda n: False), ledger)
    assert second.count() == 20 and sent(folder) == list(range(40))
    third = deliver_once(requests_of(spark, 42), outbox(folder, lambda n: False), ledger, slices=2)
    assert third.count() == 2 and sent(folder) == list(range(42))
    failed = first.where("status = 'failed'").first()
    assert failed.error.startswith("OSError: no answer") and failed.url and failed.body
    assert first.where("status = 'delivered' AND body IS NOT NULL").count() == 0


def test_run_that_dies_repeats_its_last_slice_only(spark, places):
    folder, ledger = places
    requests = requests_of(spark, 60)

    class Died(BaseException):
        pass

    def dies(request):
        outbox(folder, lambda n: False)(request)
        if len(sent(folder)) >= 30:
            raise Died

    with pytest.raises(Exception, match="Died"):
        deliver_once(requests, dies, ledger, slices=6)
    before = sent(folder)
    deliver_once(requests, outbox(folder, lambda n: False), ledger, slices=6)
    after = sent(folder)
    assert sorted(set(after)) == list(range(60)) and 30 <= len(before) < 60
    repeated = len(after) - 60
    assert 0 < repeated <= 60 / 6 * 2
    keys = {open(path).read() for path in glob.glob(f"{folder}/*")}
    assert len(keys) == 60  # a repeat carries the same key


def test_dead_letters(spark, places):
    folder, ledger = places
    requests = requests_of(spark, 6)
    for _ in range(4):
        deliver_once(requests, outbox(folder, lambda n: n == 5), ledger, max_attempts=2, slices=1)
    (dead,) = dead_letters(spark, ledger, 2).collect()
    assert (dead.attempts, dead.url, dead.error) == (2, "https://api.example.com/5", "OSError: no answer for 5")
    assert sent(folder) == [0, 1, 2, 3, 4]
    assert dead_letters(spark, ledger + "-none").count() == 0


def test_keys_and_empty_input(spark, places):
    folder, ledger = places
    requests = requests_of(spark, 9)
    assert deliver_once(requests.limit(0), outbox(folder, lambda n: False), ledger).count() == 0
    deliver_once(requests, outbox(folder, lambda n: False), ledger, key=["method"], slices=1)
    assert len(sent(folder)) == 1
    with pytest.raises(ValueError, match="max_attempts"):
        deliver_once(requests, print, ledger, max_attempts=0)
