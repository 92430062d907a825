"""What a cluster needs that a laptop forgives."""
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from millrace import session
spark = session.build(master="local[2]", spark__ui__enabled="false", spark__checkpoint__dir={shared!r})
assert session.work_dir(spark) == {shared!r}
from millrace.plans import landing_feed
from millrace.sources import files, manifests
root = landing_feed.landing(spark, {sf!r})
assert root.startswith({shared!r})
read = manifests.read_manifests(spark, root)
assert files.digests(files.glob_paths(spark, root + "/*/*/*/*/*/part-*")).filter("sha256 is null").count() == 0
assert read.count() > 50
print("done")
"""


def test_tasks_do_not_need_the_package_and_the_shared_folder_is_used(tmp_path, sf):
    """Python workers start elsewhere and cannot import the library."""
    script = SCRIPT.format(repo=REPO, shared=str(tmp_path / "shared"), sf=sf)
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    result = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "done" in result.stdout, result.stderr[-3000:]


def test_no_local_checkpoints_or_whole_table_collects():
    forbidden = ("localCheckpoint", "crossJoin", ".toPandas(", ".toLocalIterator(", ".rdd.")
    for folder, _, names in os.walk(os.path.join(REPO, "millrace")):
        for name in (n for n in names if n.endswith(".py")):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                text = f.read()
            assert not [w for w in forbidden if w in text], name
