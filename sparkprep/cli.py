"""Process one configured source from the command line (F2).

    spark-submit sparkprep/cli.py spec.yaml [--src-time YYYYmmdd_HHMMSS]
        [--file-path PATH] [--product master] [--date-part PART]

The spec file (YAML, or JSON) holds the same dict ``process_source`` takes.
Exit status 0 when a snapshot was written or the source is still fresh, 1 on
a failed run (bad values under ``on_error='fail'``, missing input, ...)."""

from __future__ import annotations

import argparse
import json
import logging
import sys


def load_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:  # pragma: no cover - PyYAML is optional
            raise SystemExit("PyYAML is needed for YAML specs; use JSON instead") from e
        return yaml.safe_load(text)
    return json.loads(text)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("spec")
    ap.add_argument("--src-time", default="")
    ap.add_argument("--file-path", default="")
    ap.add_argument("--product", default="master")
    ap.add_argument("--date-part", default="")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")

    from sparkprep.plans.process import process_source
    from sparkprep.session import get_spark

    spark = get_spark()
    try:
        res = process_source(spark, load_spec(args.spec), src_time=args.src_time, file_path=args.file_path,
                             product=args.product, date_part=args.date_part)
    except Exception:  # the run fails as a whole: no snapshot is written
        logging.exception("processing failed")
        return 1
    logging.info("%s: snapshot %s at %s", res.status, res.snapshot, res.path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
