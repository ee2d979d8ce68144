"""One Spark query and, where SQL can say it, one SQL statement per operator."""
