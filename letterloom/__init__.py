"""letterloom: message-log analytics as Spark DataFrame operators."""
