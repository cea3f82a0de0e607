"""The layers as pure frame-to-frame steps: bronze, silver, gold, and questions on top."""
