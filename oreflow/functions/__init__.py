from oreflow.functions.columns import event_time, money, signed_quantity, ticker_of

__all__ = ["event_time", "money", "signed_quantity", "ticker_of"]
