"""Visit analytics and star-schema extraction on Spark."""
