import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workers_get_the_package(tmp_path):
    """A session in another folder, without PYTHONPATH, where only the driver knows the package."""
    program = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as entry
        from parcelmill.session import build_session
        spark = build_session("elsewhere", "local[2]", **{{
            "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path / "shared")!r}}})
        for name in ("forecast", "isolation_scores"):
            print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "forecast" in done.stdout and "isolation_scores" in done.stdout
