"""Who may publish, also where files are not created atomically."""

import threading
import time

import pytest
from helpers import rows_of
from test_store import MONTH
from test_upsert import A, B, T0, T1, grid

from gridtide import schemas
from gridtide.sources import datasets, tables
from gridtide.sources.claims import FAILED, Claims, HadoopFiles


class LookThenWrite:
    """An object store: ``create`` looks, waits, and writes over whatever has
    come meanwhile. ``turn`` lets a test hold it between the two."""

    atomic = False

    def __init__(self, wait=0.0):
        self.held, self.wait, self.turn = {}, wait, None

    def create(self, path, content):
        if path in self.held:
            return False
        if self.turn:
            self.turn.wait(10)
        time.sleep(self.wait)
        self.held[path] = content
        return True

    def write(self, path, content):
        self.held[path] = content

    def read(self, path):
        return self.held.get(path)


def test_of_loads_that_start_together_exactly_one_publishes():
    for attempt in range(20):
        files, taken = LookThenWrite(wait=0.002 * (attempt % 3)), []
        files.turn = threading.Barrier(8)  # all have looked before any writes

        def load():
            taken.append(Claims(files, "root", settle=0.1).take(4))

        threads = [threading.Thread(target=load) for _ in range(8)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        (winner,) = [c for c in taken if c]
        assert winner[0] == 5 and files.read("root/_claim-5") == winner[1]


def test_a_load_held_up_while_it_claims_finds_out_before_it_publishes():
    files = LookThenWrite()
    slow = Claims(files, "root", settle=0)
    number, token = slow.take(0)
    # Another load looked before, and writes only now.
    files.write("root/_claim-1", "other")
    assert not slow.holds(number, token)
    slow.give_up(number, token)
    assert files.read("root/_claim-1") == "other"


def test_the_number_of_a_failed_load_is_not_used_again(spark, tmp_path):
    claims = Claims(HadoopFiles(spark, str(tmp_path)), str(tmp_path))
    assert claims.files.atomic
    number, token = claims.take(0)
    assert claims.take(0) is None
    claims.give_up(number, token)
    assert claims.files.read(claims.path(1)) == FAILED
    assert claims.take(0)[0] == 2 and claims.take(1) is None and claims.take(2)[0] == 3


def test_two_loads_into_one_store(spark, tmp_path):
    store = tables.MarketStore(spark, str(tmp_path / "s"))
    done, lost = [], []
    ready = threading.Barrier(2)

    def load(run):
        own = tables.MarketStore(spark, store.root)
        live = own.live
        own.live = lambda: (live(), ready.wait(60))[0]  # both have seen the same state
        try:
            done.append((own.load_hourly(grid(spark, MONTH), run, T0), run))
        except RuntimeError as error:
            lost.append(str(error))

    threads = [threading.Thread(target=load, args=(r,)) for r in ("r1", "r2")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) == len(lost) == 1 and "claimed by another load" in lost[0]
    assert {r.updated_run_id for r in store.read(tables.HOURLY).collect()} == {done[0][1]}


def test_a_claim_lost_while_loading_publishes_nothing(spark, tmp_path, monkeypatch):
    store = tables.MarketStore(spark, str(tmp_path / "s"))
    store.load_hourly(grid(spark, A), "r1", T0)
    checked = tables.upsert.check_constraints

    def meanwhile(*args, **kwargs):
        store.claims.files.write(store.claims.path(2), "other")
        return checked(*args, **kwargs)

    monkeypatch.setattr(tables.upsert, "check_constraints", meanwhile)
    with pytest.raises(RuntimeError, match="went to another load"):
        store.load_hourly(grid(spark, B), "r2", T1)
    assert max(store.live().values()) == (1,)


@pytest.mark.parametrize("stop_at", [1, 2])
def test_a_replacement_that_stops_half_way_leaves_a_dataset(spark, tmp_path, monkeypatch, stop_at):
    target, moves = f"{tmp_path}/d", []
    datasets.write_dataset(spark.range(3), target)
    datasets.write_dataset(spark.range(5), f"{target}.new")
    move = datasets._move

    def stops(*args):
        moves.append(args)
        if len(moves) == stop_at:
            raise OSError("stopped")
        move(*args)

    with monkeypatch.context() as m:
        m.setattr(datasets, "_move", stops)
        with pytest.raises(OSError, match="stopped"):
            datasets.replace(spark, f"{target}.new", target)
    assert datasets.read_dataset(spark, target).count() == 3
    datasets.replace(spark, f"{target}.new", target)
    assert rows_of(datasets.read_dataset(spark, target), "id") == [(i,) for i in range(5)]
    assert not datasets.path_exists(spark, f"{target}.old")


def test_deltas_of_one_load_only(spark, tmp_path):
    store = tables.MarketStore(spark, str(tmp_path / "s"), deltas=True)
    store._claim(store.live())
    with pytest.raises(RuntimeError, match="claimed by another load"):
        store.load_hourly(grid(spark, A), "r1", T0)
    store.clean_up()
    assert store.load_hourly(grid(spark, A), "r1", T0) == 2
    assert store.read(tables.HOURLY).select(schemas.LOCAL_HOUR).distinct().count() == 2
