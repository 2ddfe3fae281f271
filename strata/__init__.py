"""strata: layered (bronze / silver / gold) retail lakehouse jobs on Spark.

Every transform is ``DataFrame -> DataFrame`` built from the DataFrame API so
Catalyst and AQE plan it; only the snapshot store, the jobs and the streaming
helpers write. Clock columns take an explicit ``as_of`` so reruns agree.
"""

__version__ = "0.1.0"
