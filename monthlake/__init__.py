"""monthlake: a Spark-native toolkit for a monthly, layered contracts-and-workforce warehouse.

Layers: raw (all-string period files) -> bronze (typed) -> silver (dimensions + fact)
-> gold (latest-period mart), plus declarative quality checks and paged serving.
Everything is expressed with DataFrame / SQL built-ins so Catalyst plans the work.
"""

__version__ = "0.1.0"
