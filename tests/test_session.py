import os
import subprocess
import sys

import pytest

from strata.session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from strata import get_spark
from strata.sources.links import table_links
spark = get_spark("local[2]", 2)
html = '<table class="table"><tr><td></td></tr><tr><td><a href="/x">x</a></td></tr></table>'
rows = table_links(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()
assert [(r.name, r.url) for r in rows] == [("x", "/x")]
spark.stop()
"""


def test_workers_find_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=240)
    assert out.returncode == 0, out.stderr[-2000:]


def test_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
