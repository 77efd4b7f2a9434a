"""The driver's tables seen as vessel data, the registered queries and their SQL counterparts."""
