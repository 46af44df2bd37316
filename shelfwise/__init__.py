"""shelfwise: retail demand forecasting and replenishment on Spark DataFrames."""
