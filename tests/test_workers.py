"""Python tasks import the package whatever the driver's working directory."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workbook_scan_from_another_directory(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from quayside.session import build_session
        from quayside.plans.workbook_stage import write_workbook
        from quayside.sources.workbook import read_workbook_cells
        spark = build_session("local[2]", shuffle_partitions=2)
        write_workbook({str(tmp_path)!r} + "/a.xlsx", "S", ["k", "v"], iter([(1, "x"), (2, "y")]))
        print("ROWS", read_workbook_cells(spark, {str(tmp_path)!r}).count())
        spark.stop()
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd="/tmp", env=env,
                         capture_output=True, text=True, timeout=300)
    assert "ROWS 3" in out.stdout, out.stderr[-2000:]
