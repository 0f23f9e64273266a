"""Stage 3: score a batch of records with the exported models.

    python -m pondlens.plans.score --models DIR --input PATH --out PATH [--input-format json|csv|parquet]

Loads whichever target models exist (a missing one leaves its prediction
column NULL), validates every record (invalid rows are flagged, not
dropped), and writes clipped predictions. For a continuous feed of records
use ``pondlens.streaming.scoring_stream``.
"""

from __future__ import annotations

import argparse

from pondlens.operators import models as M
from pondlens.operators import scoring as SC
from pondlens.session import get_spark
from pondlens.sources.sinks import write_table
from pondlens.streaming.scoring_stream import REQUEST_SCHEMA


def run(spark, model_dir: str, input_path: str, out_path: str, input_format: str = "json") -> str:
    models = M.load_models(model_dir)
    feats = M.load_metadata(spark, model_dir).get("feature_names", {})
    reader = spark.read.schema(REQUEST_SCHEMA)
    if input_format == "csv":
        reader = reader.option("header", True)
    records = reader.format(input_format).load(input_path)
    return write_table(SC.score(records, models, feats), out_path)


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--models", required=True)
    ap.add_argument("--input", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--input-format", default="json", choices=["json", "csv", "parquet"])
    a = ap.parse_args()
    print(run(get_spark(app="pondlens-score"), a.models, a.input, a.out, a.input_format))


if __name__ == "__main__":
    main()
