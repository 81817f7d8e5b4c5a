"""Resume inputs (S12): a ``resumes(resume_id, text)`` frame or stream; text may be missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The default text of an empty request and the canned resume that
# the keyword ``magic`` stands for (a leading newline, one line, a newline and
# two spaces), exactly as the reference's web form uses them.
DEFAULT_RESUME = "No Resume Loaded"
MAGIC_KEYWORD = "magic"
MAGIC_RESUME = (
    "\n"
    'Skills Summary    Programming Languages Experience (Ployglot): C/C++/C# (VS & GNU) Java Javascript / AJAX / XML / JSON Golang Scala Perl PHP Assembly Kafka   Big Data and Database: Spark, Hadoop DFS, Map/Reduce, Solr, Storm, AWS, HBase, Hive, Pig, SQL, Postgres, SQLite   Engineering Tools: Wireshark, tcpdump, wget, Curl, Netcat, Apache Bench, Charles Proxy, SOAP UI Firefox/Chrome (plug-ins ex: Web development, headers, Firebug, GreaseMonkey …) Winscp, Putty, Secure CRT, ssh/scp Cygwin (sshd, gcc, g++, X-Windows, Bash …) Visual Studio, Eclipse, ADB   Operating Systems: Windows, Linux/*nix, OS/X, DOS, CP/M, RTOS, Android   Productivity Applications: MS Office/Project/PPT, source control (Perforce, CVS), compression (zip, tar, pdf) Remote Desktop, WebEx, VNC, CIPE, XTerm, VPN, NX Machine Hardware Productivity Tools: Oscilloscope, Logic / Spectrum Analyzer, Spectrophotometer, DVM, Waveform Generator Professional Services, Sales, Marketing & Project Management: Strong written and verbal communications Sales Support Partner Implementations Internationally adept (customs & cultural sensitivity) World and U.S. travel experience Product rollout plans (engineering & marketing) Project & team coordination Multitask / handle multiple projects and customers Present / train (& prepare) technical and non-technical groups Product requirements / specifications, change requests and design proposals Create / contribute sales / support / marketing material (app notes, FAQs, brochures, manuals …) Excellent customer service and ‘customer farming’ skills Comprehensive understanding of business systems and procedures Business / product opportunity plans Product launch / lifecycle plans   Foreign Languages: Rudimentary Swedish Hobbies & Interests: Cooking, Blues / Ballroom Dancing, Exercise, Tech Blogs, Software Programming Languages & Algorithms, Puzzles, & Coding Challenges'
    "\n  "
)


def resume_requests(df: DataFrame, key: str = "resume_id", text_col: str = "text") -> DataFrame:
    """``(key, text)`` with the default and the canned resume filled in."""
    t = F.coalesce(F.col(text_col), F.lit(DEFAULT_RESUME))
    t = F.when(t == F.lit(MAGIC_KEYWORD), F.lit(MAGIC_RESUME)).otherwise(t)
    return df.select(key, t.alias("text"))
