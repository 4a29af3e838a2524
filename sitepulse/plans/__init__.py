"""The jobs: functions from input DataFrames and parameters to report DataFrames."""
