"""meterlake: meter readings as Spark DataFrames, from source file to lake table.

Every public function takes DataFrames and returns DataFrames; Spark plans,
partitions and runs the work.
"""

__version__ = "0.1.0"
