"""tripflow: trip analytics and demand forecasting on Spark."""
