import random

import pytest

from tests.conftest import physical_plan
from varve.sources import (
    extract_from_lines,
    extract_from_texts,
    file_report,
    file_report_from_lines,
    mark_lines,
    read_embedded_table,
)
from varve.sources.embedded import table_bounds

COLUMNS = ["Year", "Jan", "J-D"]

TITLED = """Some title line
Year,Jan,J-D
1880,-.18,-.17
2016,1.17,***
2026,1.10,***

Year,Jan
1999,9
"""
TEXT_STOP = "Year,Jan,J-D\n1900,.1,.2\nDivide by 100\n1901,.3,.4\n"
TO_THE_END = "  Year,Jan,J-D\r\n1950,1,2\r\n 1951 ,3,4"
REORDERED = 'title\nYear,J-D,Jan\n1960,"a, ""b""",5\n1961,6,7,surplus\n1962,8\n'
HEADLESS = "no header\n1880,1,2\n"
EMPTY = ""

FILES = {
    "a.csv": TITLED,
    "b.csv": TEXT_STOP,
    "c.csv": TO_THE_END,
    "d.csv": REORDERED,
    "e.csv": HEADLESS,
    "f.csv": EMPTY,
}

EXPECTED = [
    ("a.csv", "1880", "-.18", "-.17"),
    ("a.csv", "2016", "1.17", None),
    ("a.csv", "2026", "1.10", None),
    ("b.csv", "1900", ".1", ".2"),
    ("c.csv", " 1951 ", "3", "4"),
    ("c.csv", "1950", "1", "2"),
    ("d.csv", "1960", "5", 'a, "b"'),
    ("d.csv", "1961", "7", "6"),
    ("d.csv", "1962", None, "8"),
]

REPORT = [
    ("a.csv", True, 3),
    ("b.csv", True, 1),
    ("c.csv", True, 2),
    ("d.csv", True, 3),
    ("e.csv", False, 0),
    ("f.csv", False, 0),
]


def texts(spark, files=FILES):
    return spark.createDataFrame(list(files.items()), "file string, text string")


def lines(spark, files=FILES):
    placed = [
        (name, i // 3, i, line)
        for name, text in files.items()
        for i, line in enumerate(text.replace("\r\n", "\n").split("\n"))
    ]
    random.Random(1).shuffle(placed)
    return mark_lines(spark.createDataFrame(placed, "file string, part int, pos int, line string"))


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_table_from_whole_texts(spark):
    assert plain(extract_from_texts(texts(spark), COLUMNS)) == sorted(EXPECTED, key=str)


def test_table_from_lines(spark):
    assert plain(extract_from_lines(lines(spark), COLUMNS)) == sorted(EXPECTED, key=str)


def test_reports_name_the_files_without_header(spark):
    assert plain(file_report(texts(spark))) == REPORT
    assert plain(file_report_from_lines(lines(spark))) == REPORT


def random_file(rng):
    """A text and the rows of its first table, both written side by side."""
    text, rows, state = [], [], "before"
    for _ in range(rng.randint(0, 4)):
        for _ in range(rng.randint(0, 2)):
            text.append("title")
            state = "after" if state == "inside" else state
        if rng.random() < 0.7:
            header = rng.choice(["Year,Jan,J-D", "Year,J-D,Jan", "Year,Jan"])
            text.append(header)
            names = header.split(",")
            state = {"before": "inside", "inside": "after", "after": "after"}[state]
        for _ in range(rng.randint(0, 5)):
            values = [str(rng.randint(1000, 2999)), rng.choice(["***", "1", "-.2"]), str(rng.randint(0, 9))]
            text.append(",".join(values))
            if state == "inside":
                value = {n: None if v == "***" else v for n, v in zip(names, values, strict=False)}
                rows.append(tuple(value.get(c) for c in COLUMNS))
        tail = rng.choice([[], [""], ["12345,1,2"], ["x,1"]])
        text += tail
        state = "after" if tail and state == "inside" else state
    return "\n".join(text), rows


def test_both_ways_agree_on_random_files(spark):
    rng = random.Random(7)
    made = {f"{i}.csv": random_file(rng) for i in range(200)}
    files = {name: text for name, (text, _) in made.items()}
    wanted = sorted([(n, *r) for n, (_, rows) in made.items() for r in rows], key=str)
    assert plain(extract_from_texts(texts(spark, files), COLUMNS)) == wanted
    assert plain(extract_from_lines(lines(spark, files), COLUMNS)) == wanted


MARKED = "\ufeffYear,Jan,J-D\n1880,1,2\n"
ROW_LIKE = "1900h,Jan,J-D\n1880,1,2\n1900,3,4\n1881,5,6\nend\n1882,7,8\n"


def test_marks_and_rows_that_begin_like_the_header(spark, tmp_path):
    path = write(tmp_path / "m", {"m.csv": MARKED})
    assert plain(read_embedded_table(spark, path, COLUMNS)) == [("1880", "1", "2")]
    assert plain(extract_from_texts(texts(spark, {"m": MARKED}), COLUMNS)) == [("m", "1880", "1", "2")]
    path = write(tmp_path / "r", {"r.csv": ROW_LIKE})
    got = read_embedded_table(spark, path, ["1900h", "J-D"], header_prefix="1900")
    assert plain(got) == [("1880", "2"), ("1900", "4"), ("1881", "6")] or plain(got) == [
        ("1880", "2"), ("1881", "6"), ("1900", "4")
    ]


def test_columns_come_from_the_headers(spark, tmp_path):
    path = write(tmp_path / "in", {"a.csv": "Year,B,A\n1900,1,2\n", "b.csv": "Year,C\n1901,3\n"})
    got = read_embedded_table(spark, path, work_dir=str(tmp_path / "work"))
    assert got.columns == ["Year", "B", "A", "C"]
    assert plain(got) == [("1900", "1", "2", None), ("1901", None, None, "3")]
    assert (tmp_path / "work" / "lines").is_dir()


def test_bounds_and_rows_take_three_scans(spark, tmp_path):
    path = write(tmp_path / "in", FILES)
    lines_ = read_embedded_table(spark, path, COLUMNS)  # stores the lines and the bounds
    assert len(lines_.inputFiles()) >= 1
    marked = lines(spark)
    marked.write.parquet(str(tmp_path / "lines"))
    bounds = table_bounds(spark.read.parquet(str(tmp_path / "lines")))
    bounds.collect()
    plan = physical_plan(bounds).split("Initial Plan")[0]
    assert plan.count("Scan parquet") - plan.count("ReusedExchange") <= 3


def write(folder, files):
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_bytes(text.encode())
    return str(folder)


def named(df):
    return sorted(((r["file"].rsplit("/", 1)[1], *tuple(r)[1:]) for r in df.collect()), key=str)


def test_files_of_a_folder(spark, tmp_path):
    path = write(tmp_path / "in", {**FILES, "notes.txt": TITLED})
    got = read_embedded_table(spark, path, COLUMNS, keep_file=True)
    assert named(got) == sorted(EXPECTED, key=str)
    assert read_embedded_table(spark, path, COLUMNS).columns == COLUMNS


def test_a_file_cut_into_many_splits(spark, tmp_path):
    rows = [f"{1000 + i % 9000},{i},{i % 7}" for i in range(20_000)]
    big = "\n".join(["title", "Year,Jan,J-D", *rows, "", "Year,Jan", "1999,9", *rows[:50]]) + "\n"
    path = write(tmp_path / "in", {"big.csv": big, **FILES})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        got = read_embedded_table(spark, path, COLUMNS, keep_file=True)
        found = named(got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    large = [("big.csv", *row.split(",")) for row in rows]
    assert found == sorted([*EXPECTED, *large], key=str)


def test_no_matching_file_is_an_error(spark, tmp_path):
    path = write(tmp_path / "in", {"a.txt": TITLED})
    with pytest.raises(FileNotFoundError):
        read_embedded_table(spark, path, COLUMNS)
