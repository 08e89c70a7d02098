"""CSV files read in ranges: state maps, records across borders, binding, streams."""

import csv
import io
import random

import pytest

from millrace.names import CORRUPT
from millrace.sources import split_csv as split
from millrace.sources.split_csv import FIELD, PLAIN, QUOTE, QUOTED, RECORD, STATES, read_csv_split
from millrace.streaming.loader import load_large_files


def by_bytes(data, state=RECORD):
    """State after the data and where records begin, one byte after the other."""
    begins = [0]
    for at, c in enumerate(data):
        if c == ord("\n") and state != QUOTED:
            state = RECORD
            begins.append(at + 1)
        elif c == ord(",") and state != QUOTED:
            state = FIELD
        elif c == ord('"'):
            state = {RECORD: QUOTED, FIELD: QUOTED, PLAIN: PLAIN, QUOTED: QUOTE, QUOTE: QUOTED}[state]
        elif state != QUOTED:
            state = PLAIN
    return state, [b for b in begins if b < len(data)]


@pytest.mark.parametrize("piece", [3, 7, 1 << 20])
def test_ranges_of_any_width_give_the_records_of_the_file(monkeypatch, piece):
    monkeypatch.setattr(split, "PIECE_BYTES", piece)
    rules, rng = split.grammar(","), random.Random(piece)
    for _ in range(3000):
        data = "".join(rng.choices('ab",\n', weights=[3, 1, 2, 2, 1], k=rng.randint(1, 50))).encode()
        end, begins = by_bytes(data)
        assert all(rules.advance(s, data) == by_bytes(data, s)[0] for s in STATES)
        width, state, found, file = rng.randint(1, 14), RECORD, [], io.BytesIO(data)
        for low in range(0, len(data), width):
            ends, firsts = split._scan_range(file, low, min(low + width, len(data)), rules)
            if firsts[state] is not None:
                found += [line for line, _ in split._records(file, firsts[state], min(low + width, len(data)), rules)]
            state = ends[state]
        whole = [data[a:b] for a, b in zip(begins, [*begins[1:], len(data)])]
        assert state == end and found == [w[:-1] if w.endswith(b"\n") and (end == RECORD or w is not whole[-1]) else w for w in whole]


def test_a_record_too_long_is_named_and_the_next_ones_are_read(monkeypatch):
    monkeypatch.setattr(split, "RECORD_BYTES", 100)
    monkeypatch.setattr(split, "PIECE_BYTES", 32)
    data = b'1,a\n2,"' + b'x\n""' * 200 + b'"\n3,c\n4,d'
    found = list(split._records(io.BytesIO(data), 0, len(data), split.grammar(",")))
    assert found == [(b"1,a", 3), (None, 804), (b"3,c", 3), (b"4,d", 3)]
    assert list(split._records(io.BytesIO(data[:300]), 0, 300, split.grammar(","))) == [(b"1,a", 3), (None, 296)]


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_one_file_is_read_by_as_many_tasks_as_ranges(spark, tmp_path):
    rng = random.Random(3)
    rows = [(str(k), rng.choice(["plain", "two\nlines", 'a "quoted" word', "a,b", "\n\n", 'x","y\n"'])) for k in range(4000)]
    with open(tmp_path / "big.csv", "w", newline="") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerows([("key", "note"), *rows])
    size = (tmp_path / "big.csv").stat().st_size
    files = split.csv_files(spark, str(tmp_path))
    lines = split.split_records(files, range_bytes=1 << 10)
    # Ranges in which a record begins; records are shorter than a range here, so that is all of them.
    assert lines.rdd.getNumPartitions() == -(-size // (1 << 10)) > 50
    read = read_csv_split(spark, str(tmp_path), ["note", "key"], range_bytes=1 << 10)
    assert rows_of(read, "key", "note") == sorted(rows)
    assert read.where(f"`{CORRUPT}` is not null").count() == 0
    assert rows_of(read_csv_split(spark, str(tmp_path), ["key", "note"]), "key", "note") == sorted(rows)


def test_more_ranges_than_a_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(split, "RUN", 3)
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f'{k},"a\n{k},b"\n' for k in range(60)))
    read = read_csv_split(spark, str(tmp_path), ["k", "v"], range_bytes=16)
    assert rows_of(read, "k", "v") == sorted((str(k), f"a\n{k},b") for k in range(60))


def test_headers_marks_and_odd_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(split.BOM + b'"code",label\r\n1,"two\r\nlines"\r\n\r\n2,x,y\r\n')
    (tmp_path / "b.csv").write_bytes(b"label,code\nlast,3")
    (tmp_path / "c.csv").write_bytes(b"")
    (tmp_path / "d.csv").write_bytes(b"code\n4\n")
    (tmp_path / "e.csv").write_bytes(b'code,label\n5,"never closed\n6,z\n')
    for size in (8, 1 << 20):
        rows = {(r["code"], r["label"], r[CORRUPT] is not None) for r in read_csv_split(spark, str(tmp_path), ["code", "label"], range_bytes=size).collect()}
        assert {("1", False), ("2", True), ("3", False), ("4", False)} <= {(c, bad) for c, _, bad in rows}
        assert ("3", "last", False) in rows and ("4", None, False) in rows and len(rows) == 5
    only_empty = tmp_path / "none"
    only_empty.mkdir()
    (only_empty / "c.csv").write_bytes(b"")
    assert read_csv_split(spark, str(only_empty), ["code"]).collect() == []
    with pytest.raises(ValueError):
        split.grammar("||")


def test_a_stream_of_large_files_takes_each_once(spark, tmp_path):
    landing, target, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    landing.mkdir()

    def put(name, start):
        (landing / name).write_text("k,v\n" + "".join(f'{k},"a\n{k}"\n' for k in range(start, start + 50)))

    put("clients_20250101_000000.csv", 0)
    put("clients_20250102_000000.csv", 100)
    first = load_large_files(spark, str(landing), str(target), str(state), ["k", "v"], range_bytes=64, files_per_batch=1)
    put("clients_20250103_000000.csv", 200)
    second = load_large_files(spark, str(landing), str(target), str(state), ["k", "v"], range_bytes=64)
    assert (first, second) == (2, 1)
    rows = spark.read.parquet(str(target))
    assert sorted(int(r.k) for r in rows.collect()) == [*range(50), *range(100, 150), *range(200, 250)]
    assert rows.select("FILE_NAME_RECEIVED").distinct().count() == 3
