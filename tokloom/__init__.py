"""tokloom: a Spark-native engine for building and measuring code/text
training corpora (discovery, quotas, byte-level BPE, token streams,
windows, fill-in-the-middle, evaluation statistics)."""

import sys as _sys

__version__ = "0.1.0"

# Python tasks (pandas UDFs, mapInPandas) must not depend on the package
# being installed on executors: ship its functions by value.
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
