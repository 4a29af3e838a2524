"""sitepulse: monitoring analytics for fleets of unattended sites, as Spark jobs.

``functions``  column expressions (ages, buckets, labels, clean-up)
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers, writers and the ticket table merge
``plans``      the jobs a user runs
``streaming``  the same results on Structured Streaming
``catalog``    every job and operator bound to the sample tables, with its SQL check
"""
