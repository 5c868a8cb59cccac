"""Functions that run in tasks must load where this package is not installed."""

import os
import subprocess
import sys
from functools import partial

from pyspark import cloudpickle

from kilowatch.operators import scoring
from kilowatch.streaming import scorer

LOAD = """
import pickle, sys
for path in sys.argv[1:]:
    assert callable(pickle.load(open(path, 'rb')))
assert not [m for m in sys.modules if m.startswith('kilowatch')]
"""


def test_task_functions_travel_by_value(tmp_path):
    functions = [partial(scoring._count_along, sustained=5), scorer.MeterScorer({}, 1).handleInputRows]
    paths = []
    for i, fn in enumerate(functions):
        path = tmp_path / f"fn{i}.pkl"
        path.write_bytes(cloudpickle.dumps(fn))
        paths.append(str(path))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", LOAD, *paths], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
