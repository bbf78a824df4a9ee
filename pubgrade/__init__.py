"""Quality measurement and improvement of publication metadata on Spark."""
