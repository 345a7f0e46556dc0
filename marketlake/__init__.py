"""marketlake: layered e-commerce analytics (detail -> middle -> summary -> report) on PySpark.

Every operator is a ``DataFrame -> DataFrame`` function.  Stateless operators run unchanged on
batch and streaming DataFrames; the three order-dependent visitor operators have a skew-safe batch
form (``marketlake.operators.visitors``) and a stateful streaming form (``marketlake.streaming``).
"""

__version__ = "0.1.0"
