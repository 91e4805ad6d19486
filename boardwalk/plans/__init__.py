"""Plans: the board from tables, and the questions asked of it."""

from boardwalk.plans.adhoc import QUERIES
from boardwalk.plans.board_plan import latest_trip_board, messages, trip_board

__all__ = ["QUERIES", "latest_trip_board", "messages", "trip_board"]
