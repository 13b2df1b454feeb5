"""The four commands, end to end on the fixture files."""

import json

import pytest

from basketry.cli import main


@pytest.fixture(scope="module")
def root(spark, csv_folder, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cli")
    assert main(["load", "--sources", csv_folder, "--warehouse", f"{folder}/w"]) == 0
    return folder


def test_load_twice(root, csv_folder, capsys):
    assert main(["load", "--sources", csv_folder, "--warehouse", f"{root}/w"]) == 1
    assert "already contains load data" in capsys.readouterr().err
    assert main(["load", "--warehouse", f"{root}/w", "--validate-only"]) == 0
    assert json.loads(capsys.readouterr().out)["table_counts"]["fact_orders"] == 5


@pytest.mark.parametrize("arguments", [
    ["load", "--warehouse", "w", "--sources", "s", "--reset-data"],
    ["load", "--warehouse", "w", "--reset-data", "--yes", "--validate-only"],
    ["load", "--warehouse", "w"],
    ["load", "--warehouse", "w", "--dry-run"],
    ["recommend", "--warehouse", "w", "--rules", "r", "--clusters", "c"],
    ["basket", "--warehouse", "w", "--output", "o", "--full", "--order-limit", "5"],
])
def test_unsafe_or_incomplete_arguments(arguments):
    with pytest.raises(SystemExit):
        main(arguments)


def test_dry_run(csv_folder, tmp_path, capsys):
    assert main(["load", "--sources", csv_folder, "--warehouse", "unused", "--dry-run"]) == 0
    assert main(["load", "--sources", str(tmp_path), "--warehouse", "unused", "--dry-run"]) == 1
    assert "Source files not found" in capsys.readouterr().err


def test_mining_and_recommendation(spark, root, capsys):
    assert main(["basket", "--warehouse", f"{root}/w", "--output", f"{root}/basket",
                 "--min-support", "0.2", "--min-confidence", "0.2", "--order-limit", "100"]) == 0
    metadata = json.loads((root / "basket" / "market_basket_metadata.json").read_text())
    assert metadata["transactions"] == 5 and metadata["mode"] == "deterministic_sample"
    labels = root / "labels.csv"
    labels.write_text("user_id,cluster\n100,0\n200,0\n")
    assert main(["recommend", "--warehouse", f"{root}/w", "--clusters", str(labels),
                 "--rules", f"{root}/basket/association_rules",
                 "--user-id", "200", "--cart", "Whole Milk", "--top-n", "2"]) == 0
    assert "Banana" in capsys.readouterr().out
    assert main(["cluster", "--warehouse", f"{root}/w", "--output", f"{root}/cluster"]) == 1
    assert "three users" in capsys.readouterr().err
