"""Column expressions, and small Arrow functions where Spark has none.

The Arrow functions travel to executors by value, so a cluster needs no copy of
this package on its workers.
"""

from pyspark import cloudpickle

from . import distance, inverted, sound, sweep

for _module in (distance, inverted, sound, sweep):
    cloudpickle.register_pickle_by_value(_module)
