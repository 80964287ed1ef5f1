"""Values for workers that have no copy of the package."""

import os
import subprocess
import sys

import numpy as np
from pyspark import cloudpickle

from wordlens.llm import embedding_dedup, language_model, quality, worker


def test_values_go_along_without_the_package(tmp_path):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    none = np.empty(0)
    values = [embedding_dedup.Cells(x, 4, 0.3), quality.CumulativeLink(none, none, none),
              language_model.Model(1, 1, 1, 1.0, [(none, none, none)] * 2)]
    (tmp_path / "values").write_bytes(cloudpickle.dumps(values))
    code = ("import pickle, sys; found = pickle.load(open('values', 'rb')); print(*[type(v).__name__ for v in found]); "
            "print(found[0].near(found[0].leaves, 1)[0].ravel().tolist()); print('wordlens' in sys.modules)")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    n = len(values[0].leaves)
    assert said.stdout.splitlines() == ["Cells CumulativeLink Model", str(list(range(n))), "False"], said.stderr


def test_sent_and_received(spark):
    sent = worker.send(spark, {"a": [1, 2]})
    assert worker.receive(sent) == {"a": [1, 2]}


def test_kept_once():
    made = []
    for _ in range(3):
        worker.kept(("test", 1), lambda: made.append(1) or "x")
    assert made == [1]
