"""Chinese characters: traditional forms and the simplified form of each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common traditional characters and, at the same place, their simplified forms.
TRADITIONAL = (
    "萬與專業東絲兩嚴個豐臨為麗舉義烏樂喬習鄉書買亂爭於雲亞產親億僅從侖倉儀們價眾優會傘偉傳傷倫偽體僑儉債傾儲兒兌黨蘭關興"
    "養獸內岡冊寫軍農沖決況凍淨涼減憑凱擊劃劉則剛創別劑勸辦務動勵勁勞勢匯區醫華協單賣盧衛卻廠廳歷厲壓縣參雙發變號嘆聽啟吳"
    "員嗎園圍國圖圓聖場壞塊堅壇壯嵐鞏庫"
)
SIMPLIFIED = (
    "万与专业东丝两严个丰临为丽举义乌乐乔习乡书买乱争于云亚产亲亿仅从仑仓仪们价众优会伞伟传伤伦伪体侨俭债倾储儿兑党兰关兴"
    "养兽内冈册写军农冲决况冻净凉减凭凯击划刘则刚创别剂劝办务动励劲劳势汇区医华协单卖卢卫却厂厅历厉压县参双发变号叹听启吴"
    "员吗园围国图圆圣场坏块坚坛壮岚巩库"
)
# Further pairs that personal names use.
NAME_TRADITIONAL = "濤硯遠夢靜闞漁鶴遲鄺藺貴賢龍鳳錢鄭趙陳張孫陸葉鄧韓馬馮黃謝許呂蘇賈鍾譚韋顧龔萊蔣餘閻齊"
NAME_SIMPLIFIED = "涛砚远梦静阚渔鹤迟邝蔺贵贤龙凤钱郑赵陈张孙陆叶邓韩马冯黄谢许吕苏贾钟谭韦顾龚莱蒋余阎齐"

T2S = dict(zip(TRADITIONAL, SIMPLIFIED)) | dict(zip(NAME_TRADITIONAL, NAME_SIMPLIFIED))
_FROM = "".join(T2S)
_TO = "".join(T2S.values())
assert len(TRADITIONAL) == len(SIMPLIFIED) and len(NAME_TRADITIONAL) == len(NAME_SIMPLIFIED)

_TABLE = str.maketrans(T2S)


def simplify(text: str) -> str:
    """A text in simplified characters, by the table."""
    return text.translate(_TABLE)


def to_simplified(text: Column) -> Column:
    """``simplify`` as a Column function; stays in the JVM."""
    return F.translate(text, _FROM, _TO)


def is_traditional(text: Column, prefix: int = 2000, share: float = 0.02) -> Column:
    """Whether more than ``share`` of the first ``prefix`` characters change under simplification.

    The prefix is part of the definition. Empty texts are not traditional; null stays null.
    """
    head = F.left(text, F.lit(prefix))
    changed = F.length(head) - F.length(F.translate(head, _FROM, ""))
    return F.when(F.length(head) == 0, F.lit(False)).otherwise(changed / F.length(head) > share)
