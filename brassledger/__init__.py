"""brassledger: governed bank-transaction data on Spark DataFrames.

Raw contract -> standardise -> check with reason codes -> remove repeats ->
quarantine -> gate -> star schema -> marts, analyses, scorecards and
role-based views.  Every operator is a function from DataFrames to a
DataFrame; clocks, run ids, roles and thresholds are parameters.
"""
