"""parcelflow: order-fulfilment analytics as PySpark DataFrame plans.

``functions``  column expressions (cleaning, durations, distance, labels)
``operators``  reusable DataFrame -> DataFrame operators (quality checks, exact
               medians, distributed prefix sums, profiling reports, manifests diff)
``sources``    readers and writers (CSV, layered lake, manifests, splits, runs)
``plans``      the fulfilment pipeline itself (staging, features, split, model)
"""

__version__ = "0.1.0"
