from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]


def test_nothing_else_imports_this_subpackage():
    for source in (ROOT / "tabularium").rglob("*.py"):
        if "llm" not in source.relative_to(ROOT).parts:
            assert "tabularium.llm" not in source.read_text()


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries().keys()
    assert {f"p{n}_found" for n in (1, 2, 3, 4, 5, 6, 8, 9)} | {"p7_packed"} <= names
    assert __spark_entry__.oracle_sql().keys() <= names
