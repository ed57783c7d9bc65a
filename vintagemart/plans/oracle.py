"""DuckDB SQL the registered queries are checked against.

Written from the definitions, rule by rule, and sharing no expression with the
Spark code.  ``oracle`` puts the named tables a statement uses in front of it.
"""

from __future__ import annotations

import re

from ..schemas import CLICK_FEATURES

START = "date '2023-01-01'"


def _month(x: str) -> str:
    return f"cast({START} + interval ({x}) month as date)"


def _money(x: str) -> str:
    return f"cast(cast(cast(floor({x}) as bigint) as decimal(12,0))*0.01 as string)"


def number(x: str) -> str:
    t = f"trim({x})"
    return (
        f"case when regexp_matches({t}, '^_+$') or regexp_matches({t}, '^__.*__$') then null "
        f"else try_cast(regexp_replace({t}, '_+$', '') as double) end"
    )


def whole(x: str) -> str:
    return f"cast(trunc({number(x)}) as int)"


def strict(x: str) -> str:
    return f"case when regexp_matches(trim({x}), '^[+-]?\\d+$') then cast(trim({x}) as int) end"


def token(x: str, word: str) -> str:
    return f"case when trim({x}) = '{word}' then null else trim({x}) end"


def day(x: str) -> str:
    return f"cast(strptime(trim({x}), '%Y-%m-%d') as date)"


def between(x: str, low: int, high: int) -> str:
    return f"case when {x} >= {low} and {x} <= {high} then {x} end"


def ratio(a: str, b: str) -> str:
    return f"case when {a} is not null and {b} is not null and {b} > 0 then {a} / {b} end"


AGE = f"cast(trunc(try_cast(regexp_replace(trim(Age), '_+$', '') as double)) as int)"
ITEMS = (
    "cast(case when Type_of_Loan is null then 0 else "
    "len(regexp_split_to_array(regexp_replace(Type_of_Loan, ',\\s*and\\s+', ', ', 'g'), ',\\s*')) end as int)"
)
LOANS_CLEAN = (
    "case when Type_of_Loan is null and Num_of_Loan between 0 and 9 then Num_of_Loan "
    "when Type_of_Loan is not null and Num_of_Loan between 0 and 9 and Num_of_Loan = loan_type_count then Num_of_Loan "
    "when Type_of_Loan is not null and (Num_of_Loan is null or Num_of_Loan < 0 or Num_of_Loan > 9) then loan_type_count "
    "else null end"
)
EMI_CLEAN = (
    "case when Total_EMI_per_month < 0 then null "
    "when Num_of_Loan_clean = 0 and Total_EMI_per_month > 0 then null "
    "when Total_EMI_per_month > 0 and Total_EMI_per_month = floor(Total_EMI_per_month) "
    "and Total_EMI_per_month > Monthly_Inhand_Salary then null "
    "else Total_EMI_per_month end"
)
MONTHS = (
    "case when regexp_matches(Credit_History_Age, '^\\s*\\d+\\s+Years?\\s+and\\s+\\d+\\s+Months?\\s*$') then "
    "cast(regexp_extract(Credit_History_Age, '(\\d+)\\s+Years?', 1) as int) * 12 + "
    "cast(regexp_extract(Credit_History_Age, '(\\d+)\\s+Months?', 1) as int) end"
)

INTS = ["Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
        "Delay_from_due_date", "Num_of_Delayed_Payment", "Num_Credit_Inquiries"]
DOUBLES = ["Annual_Income", "Monthly_Inhand_Salary", "Changed_Credit_Limit", "Outstanding_Debt",
           "Credit_Utilization_Ratio", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance"]
FES = ", ".join(CLICK_FEATURES)


def _fe(i: int) -> str:
    x = f"cast(sum((event_id*{i})%37)-18*count(*) as string)"
    x = {3: f"case when user_id%10=0 then 'bad' else {x} end", 5: f"' '||{x}||' '",
         7: f"case when user_id%9=0 then null else {x} end"}.get(i, x)
    return f"{x} as fe_{i}"


TABLES = {
    "fx_loan_daily": f"""
select 'LN_'||cast(o.o_orderkey as string) as loan_id, 'CUS_'||cast(o.o_custkey as string) as Customer_ID,
 {_month('o.o_orderkey%14')} as loan_start_date, 10 as tenure, cast(n as int) as installment_num,
 cast(1000+(o.o_orderkey%90)*100 as float) as loan_amt,
 cast(case when o.o_orderkey%97=0 then 0 else 100+(o.o_orderkey%90)*10 end as float) as due_amt,
 cast(case when n>o.o_orderkey%13 then 0 else 100+(o.o_orderkey%90)*10 end as float) as paid_amt,
 cast(case when o.o_orderkey%101=0 then null when n>o.o_orderkey%13
   then (n-o.o_orderkey%13)*(100+(o.o_orderkey%90)*10)-(o.o_orderkey%3)*5 else 0 end as float) as overdue_amt,
 cast((10-n)*(100+(o.o_orderkey%90)*10) as float) as balance,
 {_month('o.o_orderkey%14+n')} as snapshot_date
from orders o, range(0,11) t(n)""",
    "fx_attributes": f"""
select 'CUS_'||cast(c_custkey as string) as Customer_ID, c_name as Name,
 case when c_custkey%23=0 then '-500' when c_custkey%29=0 then '2329_'
  when c_custkey%7=0 then cast(14+c_custkey%60 as string)||'_' else cast(14+c_custkey%60 as string) end as Age,
 cast(100+c_custkey%900 as string)||'-00-0000' as SSN,
 case when c_custkey%14=0 then '_______' else ' '||c_mktsegment||' ' end as Occupation,
 cast({_month('c_custkey%25')} as string) as snapshot_date
from customer""",
    "fx_financials": f"""
select 'CUS_'||cast(k as string) as Customer_ID,
 case when k%61=0 then '2400000.00' when k%59=0 then '344983.50'
  else {_money('700000+abs(c)*17')}||(case when k%11=0 then '_' else '' end) end as Annual_Income,
 case when k%37=0 then null else {_money('(700000+abs(c)*17)/12.0')} end as Monthly_Inhand_Salary,
 cast(case when k%43=0 then -1 when k%41=0 then 1412 else k%12 end as string) as Num_Bank_Accounts,
 cast(case when k%47=0 then 1381 else k%12 end as string) as Num_Credit_Card,
 cast(case when k%53=0 then 5318 else k%35 end as string) as Interest_Rate,
 case when k%31=0 then '-100' when k%67=0 then '1353' when k%71=0 then '_'
  when k%17=0 then cast((k+1)%5 as string)
  else cast(k%5 as string)||(case when k%13=0 then '_' else '' end) end as Num_of_Loan,
 case k%5 when 0 then null when 1 then 'Auto Loan' when 2 then 'Auto Loan, and Payday Loan'
  when 3 then 'Auto Loan, Not Specified, and Payday Loan'
  else ' Auto Loan, Student Loan, Not Specified, and Payday Loan ' end as Type_of_Loan,
 cast(k%66-5 as string) as Delay_from_due_date,
 case when k%19=0 then cast(k%29 as string)||'_' when k%73=0 then '4182' when k%79=0 then '-3'
  else cast(k%29 as string) end as Num_of_Delayed_Payment,
 case when k%21=0 then '_' else {_money('c/400.0')} end as Changed_Credit_Limit,
 case when k%83=0 then '1050.0' else cast(k%18 as string)||'.0' end as Num_Credit_Inquiries,
 case when k%9=0 then '_' when k%9=1 then 'Bad' when k%9<5 then 'Standard' else 'Good' end as Credit_Mix,
 {_money('abs(c)/3.0')}||(case when k%15=0 then '_' else '' end) as Outstanding_Debt,
 {_money('2000+k%3000')} as Credit_Utilization_Ratio,
 case when k%25=0 then null when k%33=0 then 'NA'
  when k%2=0 then cast(k%33 as string)||' Years and '||cast(k%12 as string)||' Months'
  else cast(k%33 as string)||' Year and '||cast(k%12 as string)||' Month' end as Credit_History_Age,
 case k%7 when 0 then 'NM' when 1 then 'Yes' when 2 then 'Yes' else 'No' end as Payment_of_Min_Amount,
 case when k%26=0 then '82331' when k%27=0 then '-5.50' else {_money('abs(c)/90.0')} end as Total_EMI_per_month,
 case when k%24=0 then '__10000__' else {_money('abs(c)/50.0')} end as Amount_invested_monthly,
 case when k%16=0 then '!@9#%8' else 'Low_spent_Small_value_payments' end as Payment_Behaviour,
 case when k%500=3 then '__-333333333333333333333333333__' else {_money('c/20.0')} end as Monthly_Balance,
 cast({_month('k%25')} as string) as snapshot_date
from (select c_custkey as k, cast(round(c_acctbal*100) as bigint) as c from customer) s""",
    "fx_clickstream": f"""
select 'CUS_'||cast(user_id as string) as Customer_ID,
 {', '.join(_fe(i) for i in range(1, 21))},
 cast({_month('extract(day from ts)-1')} as string) as snapshot_date
from events group by user_id, extract(day from ts)""",
    "missed_loan": """
select *, installment_num as mob,
 case when due_amt <> 0 then cast(ceil(cast(overdue_amt as double)/cast(due_amt as double)) as int) end as installments_missed
from fx_loan_daily""",
    "filled_loan": """
select loan_id, Customer_ID, loan_start_date, coalesce(tenure,0) as tenure,
 coalesce(installment_num,0) as installment_num, cast(coalesce(loan_amt,0) as float) as loan_amt,
 cast(coalesce(due_amt,0) as float) as due_amt, cast(coalesce(paid_amt,0) as float) as paid_amt,
 cast(coalesce(overdue_amt,0) as float) as overdue_amt, cast(coalesce(balance,0) as float) as balance,
 snapshot_date, coalesce(mob,0) as mob, coalesce(installments_missed,0) as installments_missed
from missed_loan""",
    "dated_loan": """
select *, case when installments_missed > 0
  then cast(snapshot_date - to_months(installments_missed) as date) end as first_missed_date
from filled_loan""",
    "silver_loan": """
select *, cast(case when overdue_amt > 0 then date_diff('day', first_missed_date, snapshot_date) else 0 end as int) as dpd
from dated_loan""",
    "labels30": """
select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label, '30dpd_6mob' as label_def, snapshot_date
from silver_loan where mob = 6""",
    "silver_attributes": f"""
select trim(Customer_ID) as customer_id,
 case when {AGE} < 0 or {AGE} > 100 then null else {AGE} end as age,
 {token('Occupation', '_______')} as occupation, {day('snapshot_date')} as snapshot_date
from fx_attributes""",
    "typed_fin": f"""
select *, {ITEMS} as loan_type_count from (
 select trim(Customer_ID) as Customer_ID,
  {', '.join(f'{whole(c)} as {c}' for c in INTS)},
  {', '.join(f'{number(c)} as {c}' for c in DOUBLES)},
  {token('Credit_Mix', '_')} as Credit_Mix, {token('Payment_of_Min_Amount', 'NM')} as Payment_of_Min_Amount,
  {token('Payment_Behaviour', '!@9#%8')} as Payment_Behaviour,
  trim(Type_of_Loan) as Type_of_Loan, Credit_History_Age, {day('snapshot_date')} as snapshot_date
 from fx_financials)""",
    "checked_fin": f"select *, {LOANS_CLEAN} as Num_of_Loan_clean from typed_fin",
    "silver_financials": f"""
select Customer_ID as customer_id,
 case when Annual_Income <= 180000 then Annual_Income end as annual_income,
 Monthly_Inhand_Salary as monthly_inhand_salary,
 {between('Num_Bank_Accounts', 0, 11)} as num_bank_accounts,
 {between('Num_Credit_Card', 0, 11)} as num_credit_card,
 {between('Interest_Rate', 0, 34)} as interest_rate,
 Num_of_Loan_clean as num_of_loan, Type_of_Loan as type_of_loan,
 Delay_from_due_date as delay_from_due_date,
 {between('Num_of_Delayed_Payment', 0, 28)} as num_of_delayed_payment,
 Changed_Credit_Limit as changed_credit_limit,
 {between('Num_Credit_Inquiries', 0, 17)} as num_credit_inquiries,
 Credit_Mix as credit_mix, Outstanding_Debt as outstanding_debt,
 Credit_Utilization_Ratio as credit_utilization_ratio, {MONTHS} as credit_history_age_months,
 Payment_of_Min_Amount as payment_of_min_amount, {EMI_CLEAN} as total_emi_per_month,
 Amount_invested_monthly as amount_invested_monthly, Payment_Behaviour as payment_behaviour,
 Monthly_Balance as monthly_balance, snapshot_date
from checked_fin""",
    "silver_clickstream": f"""
select trim(Customer_ID) as customer_id, {', '.join(f'{strict(c)} as {c}' for c in CLICK_FEATURES)},
 {day('snapshot_date')} as snapshot_date
from fx_clickstream""",
    "gold_attributes": """
select customer_id, snapshot_date, age, occupation,
 case when age is null then null when age < 18 then 1 else 0 end as age_under_18_flag
from silver_attributes""",
    "gold_financials": f"""
select * exclude (payment_of_min_amount),
 {ratio('total_emi_per_month', 'monthly_inhand_salary')} as emi_to_salary_ratio,
 {ratio('outstanding_debt', 'annual_income')} as debt_to_annual_income_ratio,
 {ratio('amount_invested_monthly', 'monthly_inhand_salary')} as investment_to_salary_ratio,
 {ratio('monthly_balance', 'monthly_inhand_salary')} as balance_to_salary_ratio,
 case when monthly_inhand_salary is not null and total_emi_per_month is not null
  then monthly_inhand_salary - total_emi_per_month end as income_after_emi,
 case payment_of_min_amount when 'Yes' then 1 when 'No' then 0 end as pays_minimum_amount_flag
from silver_financials""",
    "rolled": f"""
select *, count(*) over w as history_months,
 {', '.join(f'avg({c}) over w as {c}_mean_3m_raw' for c in CLICK_FEATURES)}
from silver_clickstream
window w as (partition by customer_id order by year(snapshot_date)*12+month(snapshot_date)
             range between 2 preceding and current row)""",
    "gold_clickstream": f"""
select customer_id, snapshot_date, 1 as has_clickstream,
 case when history_months = 3 then 1 else 0 end as has_full_clickstream_3m_history, {FES},
 {', '.join(f'case when history_months = 3 then {c}_mean_3m_raw end as {c}_mean_3m' for c in CLICK_FEATURES)}
from rolled""",
    "joined": """
select * from gold_attributes left join gold_financials using (customer_id, snapshot_date)
left join gold_clickstream using (customer_id, snapshot_date)""",
    "feature_store": """
select * replace (coalesce(has_clickstream, 0) as has_clickstream,
                  coalesce(has_full_clickstream_3m_history, 0) as has_full_clickstream_3m_history)
from joined""",
}


def _uses(sql: str) -> set[str]:
    return set(re.findall(r"\w+", sql)) & TABLES.keys()


def oracle(sql: str) -> str:
    """The statement with the definitions of the tables it names, directly or through others."""
    needed, todo = set(), _uses(sql)
    while todo:
        needed |= todo
        todo = {used for name in todo for used in _uses(TABLES[name])} - needed
    definitions = ",\n".join(f"{name} as ({body})" for name, body in TABLES.items() if name in needed)
    return f"with {definitions}\n{sql}" if definitions else sql


def per_column(columns, row: str, source: str) -> str:
    """One SELECT per column, united; ``{c}`` in the row text is the column."""
    return "\nunion all\n".join(
        f"select '{c}' as \"column\", {row.replace('{c}', c)} from {source}" for c in columns
    )
