import os
from pathlib import Path

# Python workers import the operators from here.
os.environ["PYTHONPATH"] = os.pathsep.join(
    filter(None, [str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH")])
)
