"""Scale run: generate N records and run the whole flow; print timings as JSON.

Usage: python tools/scale_run.py N [cores] [--check]
The output root is a fresh directory under the session's checkpoint root.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main() -> None:
    from sortpub.plans import end_to_end
    from sortpub.session import local_session, scratch_path

    n = int(sys.argv[1]) if len(sys.argv) > 1 else 5_000_000
    cores = sys.argv[2] if len(sys.argv) > 2 and sys.argv[2].isdigit() else "8"
    spark = local_session(cores, shuffle_partitions=max(8, n // 250_000), app="sortpub-scale")
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "scale")
    t0 = time.time()
    res = end_to_end.run_generated(spark, n, root)
    total = time.time() - t0
    out = {"records": n, "cores": cores, "seconds": round(total, 2),
           "generate_seconds": round(res["generate_seconds"], 2),
           "publish_seconds": round(res["publish"]["seconds"], 2),
           "sort_publish_seconds": round(res["sort"]["seconds"], 2),
           "records_per_sec": round(n / total, 1)}
    if "--check" in sys.argv:
        t1 = time.time()
        out["checks"] = end_to_end.check_outputs(spark, f"{root}/source", root, exact=False)
        out["check_seconds"] = round(time.time() - t1, 2)
    print(json.dumps(out, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
