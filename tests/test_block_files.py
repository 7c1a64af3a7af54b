import pytest

from genescreen.plans.queries import _FULL, SWITCHES
from genescreen.sources import readers as rd


def blocks_by_loop(text):
    """(text, terminated) of a file's blocks, as lines that begin with // cut it."""
    held, found = [], []
    for line in text.split("\n"):
        if line.startswith("//"):
            found.append(("\n".join(held), True))
            held = [line[2:]] if line[2:].strip() else []
        else:
            held.append(line)
    found.append(("\n".join(held), False))
    return [(x.strip("\n"), t) for x, t in found if x.strip()]


FILES = {
    "ends with a line": "Query protein: A\nxx\n//\nQuery protein: B\n\nyy\n//\n",
    "ends with slashes": "Query protein: A\nxx\n//\nQuery protein: B\nyy\n//",
    "ends open": "Query protein: A\nxx\n//\nQuery protein: Bé\nyy",
    "begins with slashes": "//\nQuery protein: A\nxx",
    "slashes alone": "//\n//\n\n//",
    "one block": "Query protein: A/B\nx//y\n",
    "a block of many splits": "Query protein: A\n" + "é" * 900 + "\n//\nQuery protein: B\n",
    "empty": "",
    "many": "".join(f"Query protein: Q{k}\n{'x' * (k % 37)}\n//\n" for k in range(200)),
}


@pytest.fixture(params=["64", "700", "128m"])
def split(spark, request):
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    for c, v in before.items():
        spark.conf.set(c, v)


def test_blocks_by_line_are_the_same_for_any_split(spark, tmp_path, split):
    for name, text in FILES.items():
        (tmp_path / f"{name}.txt").write_bytes(text.encode())
    found = {name: [] for name in FILES}
    for r in rd.read_prediction_blocks(spark, str(tmp_path), "line").collect():
        name = r.line_no.file.rsplit("/", 1)[1].removesuffix(".txt").replace("%20", " ")
        found[name].append((r.line_no.block, r.line_no.n, r.text.strip("\n"), r.terminated))
    assert {k: [x[2:] for x in sorted(v)] for k, v in found.items()} == {k: blocks_by_loop(t) for k, t in FILES.items()}


def test_the_input_is_scanned_once(spark, tmp_path):
    (tmp_path / "x.txt").write_text(FILES["many"])
    plan = rd.read_prediction_blocks(spark, str(tmp_path / "x.txt"), "line")._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in [w for line in plan.splitlines() if "Relation [" in line for w in line.split("] ")[-1:]]


def test_a_folder_of_split_files_gives_blocks_in_order(spark, tmp_path, split):
    texts = {f"{k}.gw.txt": t for k, t in enumerate(["".join(f"Query protein: F{k}\n{'é' * k}\n//\n" for k in range(120)), "", "Query protein: open\nx", "a//b\n//\n//\nc // d"])}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "other.txt").write_text("Query protein: no\n")
    found = [r.text for r in rd.read_block_dir(spark, str(tmp_path)).orderBy("line_no").collect()]
    assert found == [x for name in sorted(texts) for x in texts[name].split("//") if x.strip()]


def test_switches_stand_in_the_sql_once():
    assert all(_FULL.count(on) == 1 for on, _ in SWITCHES.values())
