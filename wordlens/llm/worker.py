"""What Python workers get from the driver, and what they keep from task to task (tokenizers and their known words)."""

from __future__ import annotations

import pickle
import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import SparkSession

#: Functions of this subpackage travel by value, so a module global would start anew in every task.
STATE = "wordlens_worker_state"


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """The worker's own object under ``key``, made at its first use."""
    state = sys.modules.setdefault(STATE, types.ModuleType(STATE)).__dict__.setdefault("kept", {})
    if key not in state:
        state[key] = make()
    return state[key]


def send(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast of a value whose class may be of this subpackage: it goes along by value, as workers need not have the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def receive(sent: Broadcast) -> Any:
    """The value that was sent, in a task."""
    return pickle.loads(sent.value)
