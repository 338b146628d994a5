"""Ship Python helpers with the tasks that use them.

Arrow UDFs are pickled by reference (module name + function name) unless their
module is registered for pickling by value; then the code travels inside the
task and executors need no copy of this package on their path.
"""

from __future__ import annotations

import types


def ship_by_value(module: types.ModuleType) -> None:
    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - very old PySpark
        return
    cloudpickle.register_pickle_by_value(module)
